"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgraph.llm import (bpe, langid, licenses, merkle, minhash, packing, pitman_yor, quality, runs, sharding, simhash,
                           substrings, urls)
from wordgraph.llm.common import id_remainder, read_table
from wordgraph.llm.tokens import public_tokenizer_path
from wordgraph.session import TableCuts

SHARDS = 40
#: The host and path rules of the URL query.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizer_path())


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op3_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.references(docs)).drop("class_divergence", "word_divergence")


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read_table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


def op5_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labelled = docs.where(~F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False)))
    pairs = langid.sample(labelled.select(F.col("doc_id").alias("key"), "text", "lang"))
    found = langid.predict(docs, langid.train(pairs) if pairs else None)
    return found.select("doc_id", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op6_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(read_table(spark, sf_dir, "documents"))


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizer_path())


def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    placed = sharding.shard_rows(docs, [F.col("doc_id").asc(), F.col("text_crc32").asc(), F.col("size").asc()], SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op9_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_simhash_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and, for every document whose id is divisible by 20, ``near_rows``:
    how many documents (itself included) have a fingerprint within the radius."""
    prints = TableCuts(spark, "simhash").cut(simhash.edited_fingerprints(read_table(spark, sf_dir, "documents")), "prints")
    as_long = F.conv("fingerprint", 16, -10).cast("long")
    counted = prints.groupBy(as_long.alias("found")).agg(F.count(F.lit(1)).alias("n"))
    asked = prints.where(F.col("doc_id") % 20 == 0).select(as_long.alias("query")).distinct()
    near = simhash.within_radius(asked, counted.select("found")).join(counted, "found").groupBy("query").agg(
        F.sum("n").alias("near_rows"))
    rows = prints.withColumn("query", F.when(F.col("doc_id") % 20 == 0, as_long))
    return rows.join(near, "query", "left").drop("query")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null id counts as the empty text for the remainder that decides on tampering."""
    docs = read_table(spark, sf_dir, "documents")
    before = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = merkle.leaf_digest(*before, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    manifest = merkle.build(docs.select(
        F.col("doc_id").alias("key"), F.col("source").alias("tree"),
        merkle.leaf_digest(*before, F.col("text")).alias("leaf"),
        F.when(id_remainder(F.col("doc_id"), 2) == 0, tampered).alias("changed")))
    return manifest.proofs().select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def tiled_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a text, of one in ten with its tail made periodic; a null id counts as the empty text."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tile = words[a:a + p]
    return words[:a] + (tile * -(-(n - a) // p))[:n - a]


def op12_synchronising_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.summary(runs.runs(read_table(spark, sf_dir, "documents"), edit=tiled_words))
    listed = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || chr(10)), '')")
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_countmin_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sum_of_squares_packing": op1_sum_of_squares_packing,
    "op2_license_scan": op2_license_scan,
    "op3_quality_divergence": op3_quality_divergence,
    "op4_url_rules": op4_url_rules,
    "op5_byte_cnn_language": op5_byte_cnn_language,
    "op6_pitman_yor_scores": op6_pitman_yor_scores,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_feistel_shards": op8_feistel_shards,
    "op9_minhash_bayes": op9_minhash_bayes,
    "op10_simhash_edits": op10_simhash_edits,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_synchronising_runs": op12_synchronising_runs,
    "op13_countmin_substrings": op13_countmin_substrings,
}

def _field(name: str) -> str:
    return f"case when {name} is null then '-' else strlen({name}::varchar) || ':' || {name}::varchar end"


_HEAD = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
_NO_BREAKS = "replace(text, chr(10), '')"
#: Levels of a table of nodes: three neighbours make a parent until a group has one node.
_LEVELS = """{name}(src, l, pos, dg, n) as ({base}
      union all
      select src, l + 1, pos // 3, sha256(string_agg(dg, '' order by pos)), (n + 2) // 3
      from {name} where n > 1 group by src, l, n, pos // 3)"""
#: Per leaf of a group and level, the joined siblings on both sides.
_SIDES = """(select a.src, a.pos leaf, l.l,
      coalesce(string_agg(b.dg, '' order by b.pos) filter (b.pos < a.pos // (3**l.l)::bigint), '') lft,
      coalesce(string_agg(b.dg, '' order by b.pos) filter (b.pos > a.pos // (3**l.l)::bigint), '') rgt
      from {name} a join (select distinct src, l, n from {name}) l on l.src = a.src and l.n > 1
      join {name} b on b.src = a.src and b.l = l.l and b.pos // 3 = a.pos // (3**(l.l + 1))::bigint
      where a.l = 0 group by a.src, a.pos, l.l)"""

_RULE_ROWS = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in URL_RULES)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: DuckDB SQL of the queries that SQL can state over whole tables in time.
ORACLE_SQL: dict[str, str] = {
    "op4_url_rules": f"""with rules(verdict, rule) as (values {_RULE_ROWS}),
    a as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end rest from pages),
    p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from a),
    r as (select *, split_part(rule, '/', 1) h, substr(rule, strpos(rule, '/')) pre from rules),
    places as (select distinct host, path from p),
    best as (select host, path, arg_max(rule, length(rule)) rule, arg_max(verdict, length(rule)) verdict from places
      join r on (host = h or suffix(host, '.' || h)) and starts_with(path, pre) group by host, path)
    select page_id, host, path, rule, coalesce(verdict, 'allow') verdict from p left join best using (host, path)""",
    "op9_minhash_bayes": f"""with recursive t as (select doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
    s as materialized (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
      else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end) g from t),
    n as materialized (select doc_id, count(*) n from s group by doc_id),
    g(s, d) as materialized (select a.doc_id, b.doc_id from s a join s b using (g)
      join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id where a.doc_id <> b.doc_id
      group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
    r(v, l) using key (v) as (
      select doc_id, doc_id from documents
      union
      select g.d, min(r.l) from r join g on g.s = r.v join recurring.r cur on cur.v = g.d
      where r.l < cur.l group by g.d)
    select doc_id, coalesce(n.n, 0) n_shingles, r.l component_id, doc_id = r.l kept
    from documents left join n using (doc_id) join r on r.v = doc_id""",
    "op11_merkle_manifest": f"""with recursive leaves as materialized (select doc_id, src,
        row_number() over (partition by src order by doc_id nulls first, leaf) - 1 pos, leaf, changed from (
      select doc_id, dense_rank() over (order by source nulls first) - 1 src, sha256({_HEAD} || {_field('text')}) leaf,
        case when list_reduce(list_transform(string_split(coalesce(doc_id::varchar, ''), ''), lambda x: ascii(x)::ubigint),
          lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::ubigint[], lambda r, z:
            case when r % 2 = 1 then xor(r // 2, 3988292384::ubigint) else r // 2 end, xor(c, b)), 4294967295::ubigint) % 2 = 1
          then sha256({_HEAD} || {_field(_NO_BREAKS)}) end changed from documents)),
    {_LEVELS.format(name='low', base="select src, 0, pos, leaf, count(*) over (partition by src) from leaves")},
    {_LEVELS.format(name='up', base="select 0, 0, src, dg, count(*) over () from low where n = 1")},
    steps as materialized (select src, leaf, l::bigint l, lft, rgt from {_SIDES.format(name='low')}
      union all select a.src, a.pos, h.h + u.l, u.lft, u.rgt from (select src, pos from low where l = 0) a
      join (select src, max(l) h from low group by src) h on h.src = a.src
      join {_SIDES.format(name='up')} u on u.leaf = a.src),
    folded(src, leaf, l, dg) as (select src, pos, 0::bigint, coalesce(changed, leaf) from leaves
      union all select f.src, f.leaf, f.l + 1, sha256(s.lft || f.dg || s.rgt) from folded f
      join steps s on s.src = f.src and s.leaf = f.leaf and s.l = f.l),
    ends as (select src, leaf, arg_max(dg, l) dg from folded group by src, leaf),
    proof as (select src, leaf, sha256(string_agg(lft || rgt, '' order by l)) p from steps group by src, leaf),
    root as (select dg from up where n = 1)
    select doc_id, a.leaf, t.dg subroot, root.dg root, coalesce(p.p, sha256('')) proof_sha256, e.dg folded_root,
      e.dg = root.dg verified
    from leaves a join low t on t.src = a.src and t.n = 1 join ends e on e.src = a.src and e.leaf = a.pos
    left join proof p on p.src = a.src and p.leaf = a.pos, root""",
    "op13_countmin_substrings": """with t as materialized (select row_number() over () r, doc_id,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
    g as materialized (select r, doc_id, i, array_to_string(w[i:i + 12], ' ') g
      from (select r, doc_id, w, unnest(range(1, len(w) - 11)) i from t)),
    gone as (select distinct r, unnest(range(i, i + 13)) p from g
      join (select g, min(doc_id) least from g group by g) using (g) where least < doc_id),
    kept as (select r, string_agg(word, ' ' order by p) k, count(*) n
      from (select r, unnest(w) word, unnest(range(1, len(w) + 1)) p from t) anti join gone using (r, p) group by r)
    select doc_id, len(w) n_words, len(w) - coalesce(n, 0) n_removed, sha256(coalesce(k, '')) kept_sha256
    from t left join kept using (r)""",
}
