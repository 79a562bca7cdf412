"""Quality rules: counts of each text, and its distance to language references.

The base rules count words, symbols, repeated lines and repeated three-word
windows. The method's own verdict compares two histograms of a text, of
character classes and of common words, with references learnt from the whole
corpus, one pair per language, by the Jensen-Shannon divergence (the square of
the distance, in bits). A text is kept if some language is near enough in
both; texts too short for a histogram pass that part. Only DataFrame functions
are used, and the only shuffles are the references' small aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordgraph.llm.common import SPACE_CLASS
from wordgraph.session import TableCuts

#: Character classes, each by the pattern that removes everything else; the
#: last class is the rest (small letters).
CLASSES = [
    ("upper", r"[^A-Z]+"),
    ("symbol", r"[^#*$%&|<>]+"),
    ("mark", r"""[^.,;:!?'"()-]+"""),
    ("beyond", r"[\x{0}-\x{7F}]+"),
    ("digit", r"[^0-9]+"),
    ("space", r"[^\x20\x09-\x0D]+"),
]


@dataclass(frozen=True)
class Limits:
    """Parameters of the verdict."""

    #: Labels with fewer texts have no reference; their own texts pass.
    min_texts: int = 5
    #: Words of a language's reference, and their greatest length.
    common_words: int = 40
    common_length: int = 4
    #: Texts with fewer characters pass the class test, with fewer words the word test.
    min_chars: int = 100
    min_words: int = 100
    #: A language's limit of the class test: this many times the upper quartile of its labelled texts' own
    #: divergences (a quarter of them may be broken without moving it), but no less than the least limit.
    class_spread: float = 25.0
    least_class_limit: float = 0.02
    #: A text passes the word test up to this part of the divergence of a text without any common word.
    max_word_part: float = 0.9
    #: Where a reference's words have a smaller share, their lack tells nothing: any text passes its word test.
    min_known: float = 0.1


@dataclass(frozen=True)
class Reference:
    """Shares of the character classes and of the common words of one language."""

    lang: str
    classes: list[float]
    words: dict[str, float] = field(default_factory=dict)
    #: Greatest class divergence that passes.
    class_limit: float = Limits.least_class_limit


def word_limit(ref: Reference, limits: Limits) -> float:
    """Greatest word divergence that passes: a part of that of a text without common words."""
    known = sum(ref.words.values())
    if known < limits.min_known:
        return 1.0
    rest = 1 - known
    inner = log2(2 / (1 + rest)) + (rest * log2(2 * rest / (1 + rest)) if rest > 0 else 0.0)
    return limits.max_word_part * (known + inner) / 2


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def base_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = None) -> DataFrame:
    """``key, text, label, words`` and the base counts of every row; a null text has none of anything.

    ``n_repeat_words``: the windows of a text are hashed (64 bits) and sorted, so
    that equal ones are neighbours; the words covered by windows that occur
    more than once are counted once each.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       (F.col(lang) if lang else F.lit(None).cast("string")).alias("label"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    rows = rows.withColumn("windows", F.expr(
        "if(size(words) < 4, cast(array() as array<bigint>), transform(sequence(0, size(words) - 3), "
        "i -> xxhash64(words[i], words[i + 1], words[i + 2])))"))
    # Most texts repeat no window, which a hash set tells sooner than sorting.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("sorted", F.when(repeats, F.sort_array("windows")))
    rows = rows.withColumn("twice", F.expr(
        "array_distinct(filter(sorted, (h, i) -> i > 0 and h = sorted[i - 1]))"))
    # Places of the repeated windows: looked up if they are few, else found by sorting hashes with their places.
    few = F.expr("filter(sequence(0, size(windows) - 1), i -> array_contains(twice, windows[i]))")
    rows = rows.withColumn("placed", F.when(F.size("twice") > 32, F.expr(
        "sort_array(transform(windows, (h, i) -> struct(h as h, i as i)))")))
    many = F.expr(
        "transform(filter(placed, (p, i) -> (i > 0 and p.h = placed[i - 1].h)"
        " or (i + 1 < size(placed) and p.h = placed[i + 1].h)), p -> p.i)")
    rows = rows.withColumn("again", F.when(F.size("twice") > 32, many).when(F.size("twice") > 0, few))
    covered = F.expr("size(array_distinct(flatten(transform(again, i -> array(i, i + 1, i + 2)))))")
    rows = rows.withColumn("n_repeat_words", F.when(F.col("again").isNull(), 0).otherwise(covered).cast("long"))
    rows = rows.withColumn("lines", F.expr(r"filter(split(text, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    return rows.select(
        "key", "text", "label", "words", "n_words", F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", CLASSES[1][1], "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"))


def class_shares(text: Column, word_chars: Column, n_symbols: Column | None = None) -> Column:
    """Shares of the character classes, the rest last; null for an empty text. ``word_chars``: all but white space."""
    total = F.length(text)
    counts = [F.length(F.regexp_replace(text, pattern, "")) for _, pattern in CLASSES[:4]]
    if n_symbols is not None:
        counts[1] = n_symbols
    # As many bytes as characters: nothing lies beyond ASCII.
    counts[3] = F.when(F.octet_length(text) == total, 0).otherwise(counts[3])
    counts += [total - F.length(F.regexp_replace(text, "[0-9]+", "")), total - word_chars]
    # The counts and their total are bound to a name, so that nothing is counted twice.
    bound = F.array(F.array(*[c.cast("long") for c in (*counts, total)]))
    shares = F.transform(bound, lambda c: F.transform(
        F.array(*[c[i] for i in range(6)], c[6] - c[0] - c[1] - c[2] - c[3] - c[4] - c[5]),
        lambda x: x.cast("double") / c[6]))
    return F.when(total > 0, shares[0])


def references(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> list[Reference]:
    """The references of all languages of the corpus, from all its labelled texts.

    Class shares are medians over the texts, so that neither a few long texts
    nor a minority of broken ones set them; word shares are of all words. What
    comes to the driver are ``limits.common_words`` words for each label with
    ``limits.min_texts`` texts.
    """
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.where(F.length("text") > 0)
    width = range(len(CLASSES) + 1)
    worded = rows.withColumn("words", words_of(F.col("text")))
    shares = TableCuts(docs.sparkSession, "quality").cut(worded.select(
        "lang", class_shares(F.col("text"), F.length(F.array_join("words", ""))).alias("c"),
        F.size("words").alias("n_words"), F.length("text").alias("n_chars")), "shares", compression="zstd")
    per_lang = shares.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("n_words"),
        *[F.percentile_approx(F.col("c")[i], 0.5, 10000).alias(f"c{i}") for i in width])
    found = per_lang.where(F.col("n") >= limits.min_texts).collect()
    classes = {r["lang"]: [r[f"c{i}"] or 0.0 for i in width] for r in found}
    totals = {r["lang"]: r["n_words"] for r in found}
    if not classes:
        return []
    held = rows.where(F.col("lang").isin(sorted(classes))).select("lang", words_of(F.col("text")).alias("words"))
    short = F.filter("words", lambda w: (F.length(w) <= limits.common_length) & w.rlike(r"\A\p{L}+\z"))
    counts = held.select("lang", F.explode(short).alias("word")).groupBy("lang", "word").agg(
        F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("word")))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= limits.common_words)
    words: dict[str, dict[str, float]] = {name: {} for name in classes}
    for r in top.collect():
        words[r["lang"]][r["word"]] = r["n"] / totals[r["lang"]]
    scaled = {name: [x / (sum(c) or 1.0) for x in c] for name, c in classes.items()}
    # How far a language's own texts are from its reference.
    own = docs.sparkSession.createDataFrame(sorted(scaled.items()), "lang string, ref array<double>")
    apart = shares.where(F.col("n_chars") >= limits.min_chars).join(F.broadcast(own), "lang").select(
        "lang", _total(F.zip_with("c", "ref", _term)).alias("d"))
    quartiles = {r["lang"]: r["q"] for r in apart.groupBy("lang").agg(
        F.percentile_approx("d", 0.75, 10000).alias("q")).collect()}
    limit = lambda name: max(limits.least_class_limit, limits.class_spread * quartiles.get(name, 0.0))
    return [Reference(name, c, words[name], limit(name)) for name, c in sorted(scaled.items())]


def _term(p: Column, q: Column) -> Column:
    """One bin's part of the Jensen-Shannon divergence, in bits."""
    part = lambda a: F.when(a > 0, a * F.log2(2 * a / (p + q))).otherwise(0.0)
    return (part(p) + part(q)) / 2


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _literals(refs: list[Reference], limits: Limits) -> Column:
    one = lambda r: F.struct(
        F.array(*[F.lit(float(x)) for x in r.classes]).alias("classes"),
        F.array(*[F.lit(w) for w in sorted(r.words)]).cast("array<string>").alias("words"),
        F.array(*[F.lit(float(r.words[w])) for w in sorted(r.words)]).cast("array<double>").alias("shares"),
        F.lit(float(sum(r.words.values()))).alias("known"), F.lit(word_limit(r, limits)).alias("word_limit"),
        F.lit(float(r.class_limit)).alias("class_limit"))
    return F.array(*[one(r) for r in refs])


def word_divergence(runs: Column, n_words: Column, ref: Column) -> Column:
    """Divergence of a text's common words, and all others as one bin, from a reference.

    Bins of the reference that the text lacks add half their share each.
    """
    places = F.transform(runs, lambda r: F.struct(
        (r["n"] / n_words).alias("p"), F.array_position(ref["words"], r["w"]).alias("at")))
    held = F.filter(places, lambda x: x["at"] > 0)
    pairs = F.transform(held, lambda x: F.struct(x["p"].alias("p"), F.get(ref["shares"], (x["at"] - 1).cast("int")).alias("q")))
    # Both sums in one go over the pairs: the inside of the divergence and the text's share.
    return F.aggregate(
        pairs, F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p")),
        lambda a, x: F.struct((a["d"] + (_term(x["p"], x["q"]) - x["q"] / 2)).alias("d"), (a["p"] + x["p"]).alias("p")),
        lambda a: a["d"] + ref["known"] / 2 + _term(F.greatest(F.lit(0.0), 1 - a["p"]), 1 - ref["known"]))


def quality(docs: DataFrame, refs: list[Reference], key: str = "doc_id", text: str = "text",
            limits: Limits = Limits(), lang: str = "lang") -> DataFrame:
    """``key``, the base counts, ``base_failed``, the least divergences over the
    languages (``class_divergence, word_divergence``; null where the text is too
    short or there is no reference) and ``kept`` for every row. A text whose
    label in ``lang`` (if there is such a column) has no reference is judged by
    the base rules alone.
    """
    labelled = lang in docs.columns
    rows = base_counts(docs, key, text, lang if labelled else None)
    keep = ["key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    none = F.lit(None).cast("double")
    if refs:
        vocabulary = sorted({w for r in refs for w in r.words})
        rows = rows.withColumn("shares", F.when(
            F.length("text") >= limits.min_chars, class_shares(F.col("text"), F.col("word_chars"), F.col("n_symbols"))))
        rows = rows.withColumn("held", F.when(
            F.col("n_words") >= limits.min_words,
            F.sort_array(F.filter("words", lambda w: w.isin(vocabulary))) if vocabulary else F.array().cast("array<string>")))
        # Where a run of equal words ends, and how long it is.
        rows = rows.withColumn("ends", F.expr(
            "filter(transform(held, (w, i) -> if(i + 1 < size(held) and held[i + 1] = w, -1, i)), i -> i >= 0)"))
        rows = rows.withColumn("runs", F.expr(
            "transform(ends, (e, j) -> struct(held[e] as w, cast(e - if(j > 0, ends[j - 1], -1) as double) as n))"))
        rows = rows.withColumn("refs", _literals(refs, limits))
        near = F.transform("refs", lambda r: F.struct(
            _total(F.zip_with("shares", r["classes"], _term)).alias("c"),
            word_divergence(F.col("runs"), F.col("n_words").cast("double"), r).alias("w"),
            r["word_limit"].alias("word_limit"), r["class_limit"].alias("class_limit")))
        rows = rows.withColumn("near", near)
        fits = F.exists("near", lambda x: (F.coalesce(x["c"], F.lit(0.0)) <= x["class_limit"])
                        & (F.coalesce(x["w"], F.lit(0.0)) <= x["word_limit"]))
        if labelled:
            fits = fits | F.coalesce(~F.col("label").isin([r.lang for r in refs]), F.lit(False))
        by_class = F.array_min(F.transform("near", lambda x: x["c"]))
        by_word = F.array_min(F.transform("near", lambda x: x["w"]))
    else:
        fits, by_class, by_word = F.lit(True), none, none
    # Always true, but not for the optimiser: a filter on ``kept`` is not pushed
    # below, where each step would be repeated for each use of its result.
    here = F.monotonically_increasing_id() >= 0
    return rows.select(
        F.col("key").alias(key), *keep[1:], (~F.col("base_failed") & fits & here).alias("kept"),
        by_class.alias("class_divergence"), by_word.alias("word_divergence"))
