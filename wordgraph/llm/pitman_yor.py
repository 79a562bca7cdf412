"""A hierarchical Pitman-Yor language model, seated by Gibbs sampling.

The root restaurant serves all words over a uniform base of the vocabulary and
one more type for unknown words. Each word seen in training is a context with a
restaurant of its own, for the words that follow it, and all contexts have the
root as parent: every customer who opens a table in a context sends a customer
to the root.

The state is the number of tables of each (previous word, word) pair seen in
training. Pairs live in chunks: packed columns of some million training tokens,
dealt by the previous word (a word with more tokens than a chunk is dealt by the
following word too), so no restaurant grows a task. A pair seen once keeps its one
table: what such pairs add to a word's sums is added up once, and sweeps carry the
other pairs and their words only. A sweep takes the tables of
a pair out of its restaurant and of the root, draws their number anew from its
distribution given everything else (``seating``), and puts them back before the
next pairs of the chunk are drawn.

Words live in parts: ranges of the sorted vocabulary, packed columns too. Words
never travel as rows: a block sends each part its words of that range and gets
their ids, and between sweeps a chunk sends each part what its pairs opened in a
word's restaurant and sent to the root for it, and gets the sums of all chunks.
Strengths and the root's discount are fitted in the first sweeps; after them the
predictive probabilities of each sweep are kept and averaged.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgraph.llm import seating
from wordgraph.llm.blocks import blocks, unpack_numbers
from wordgraph.llm.common import id_remainder, mix64, small_batches
from wordgraph.session import TableCuts


@dataclass(frozen=True)
class Params:
    sweeps: int = 6
    burn_in: int = 3
    seed: int = 7
    #: Training tokens of a chunk, on average.
    chunk_tokens: int = 1 << 21
    #: Text of a block: what a task holds of tokens, distinct words and distinct pairs grows with it.
    block_bytes: int = 8 << 20
    #: Words of blocks, and their bytes, that a part of the vocabulary is made from, on average.
    part_words: int = 1 << 20
    part_bytes: int = 32 << 20
    #: Steps of a pass over a chunk: pairs of one context are spread over them, later steps see earlier ones' tables.
    steps: int = 16


#: Words of blocks that are looked at for the bounds of the vocabulary's parts: so many for a part, and bytes of a word.
SAMPLE_WORDS, SAMPLE_BYTES = 128, 256


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + (pa.compress(data, "zstd", asbytes=True) if len(data) else b"")


def _stretch(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(pa.py_buffer(data).slice(8), size, "zstd", asbytes=True) if size else b""


def _pack(values: np.ndarray, steps: bool = False) -> bytes:
    """Whole numbers, or with ``steps`` their differences: bytes of equal weight together, compressed."""
    values = values.astype("<i8")
    if steps:
        values = np.diff(values, prepend=0)
    folded = ((values << 1) ^ (values >> 63)).view("<u8")
    # Bytes that are 0 in all numbers are left out.
    width = max(1, (int(folded.max()).bit_length() + 7) // 8) if len(folded) else 1
    planes = folded.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width + 16 * steps]) + _squeeze(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    width = data[0] % 16
    planes = np.frombuffer(_stretch(data[1:]), np.uint8).reshape(width, -1)
    folded = np.zeros((planes.shape[1], 8), np.uint8)
    folded[:, :width] = planes.T
    folded = folded.reshape(-1).view("<u8")
    values = (folded >> np.uint64(1)).astype(np.int64) ^ -(folded & np.uint64(1)).astype(np.int64)
    return np.cumsum(values) if data[0] >= 16 else values


def _unpacked(table: pa.Table, *names: str) -> list[np.ndarray]:
    """Packed columns, the values of all rows one after another."""
    none = np.zeros(0, np.int64)
    return [np.concatenate([none, *map(_unpack, table.column(c).to_pylist())]) for c in names]


def _rows(kinds: str, rows: list[dict]) -> pa.Table:
    """Rows of a schema like ``a long, b binary``; values that a row lacks are null."""
    types = {"long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
    fields = [x.rsplit(" ", 1) for x in kinds.split(", ")]
    return pa.table({c: pa.array([r.get(c) for r in rows], types[k]) for c, k in fields})


def _bounds(table: DataFrame, p: Params) -> list[bytes]:
    """Words that begin the parts of the vocabulary after the first, from some words of each block.

    They decide only how evenly the parts are filled.
    """
    held = table.where(F.size("words") > 0)
    size = F.expr("aggregate(words, 0L, (a, x) -> a + octet_length(x))")
    words, size = held.agg(F.sum(F.size("words")), F.sum(size)).first()
    parts = 1 + max((words or 0) // p.part_words, (size or 0) // p.part_bytes)
    if parts == 1:
        return []
    # One of so many words of each block, begun at another place in each.
    every = max(1, words // (SAMPLE_WORDS * parts))
    begin = f"1 + pmod(xxhash64(block), {every})"
    some = F.expr(f"if(size(words) < {begin}, array(), transform(sequence({begin}, size(words), {every}), "
                  "i -> element_at(words, cast(i as int))))")
    seen = held.select(F.explode(some).alias("word")).select(
        F.expr(f"substring(word, 1, {SAMPLE_BYTES})"), F.octet_length("word"))
    rows = sorted((bytes(word), n) for word, n in seen.collect())
    if not rows:
        return []
    weight = np.cumsum([1 / p.part_words + n / p.part_bytes for _, n in rows])
    at = np.searchsorted(weight, weight[-1] * np.arange(1, parts) / parts)
    return sorted({rows[i][0] for i in at})


_SENT = "part long, of long, sizes binary, words binary, counts binary, numbers binary"


def sent_words(table: DataFrame, bounds: list[bytes]) -> DataFrame:
    """``part, of, sizes, words, counts, numbers`` (packed): a block's words of a part, sorted."""

    def run(batches):
        for batch in batches:
            for of, own, counts in zip(batch.column("block").to_pylist(), batch.column("words"), batch.column("counts")):
                order = pc.sort_indices(own.values)
                words, numbers = own.values.take(order), order.to_numpy().astype(np.int64)
                counts = counts.values.to_numpy()[numbers]
                ends = [bisect_left(range(len(words)), x, key=lambda i: words[i].as_py()) for x in bounds] + [len(words)]
                out, first = [], 0
                for part, last in enumerate(ends):
                    if last > first:
                        sizes = pc.binary_length(words.slice(first, last - first)).to_numpy().astype(np.int64)
                        out.append({"part": part, "of": of, "sizes": _pack(sizes), "counts": _pack(counts[first:last]),
                                    "words": _squeeze(b"".join(words.slice(first, last - first).to_pylist())),
                                    "numbers": _pack(numbers[first:last])})
                    first = last
                yield from _rows(_SENT, out).to_batches()

    return table.select("block", "words", "counts").mapInArrow(run, _SENT)


@dataclass
class Vocabulary:
    """Training words have ids without gaps from 0, in the order of the words; a part has the ids from its start on."""

    numbered: DataFrame  # part, of; places, c, numbers: of a block's words of the part, in order (place -1: not in training)
    parts: DataFrame  # part, c: of each word
    starts: np.ndarray  # the first id of each part, and the number of ids
    types: int
    tokens: int


_NUMBERED = "part long, of long, places binary, c binary, numbers binary, types long, tokens long"


def vocabulary(table: DataFrame, cuts: TableCuts, p: Params = Params()) -> Vocabulary:
    """The words of training texts, numbered, and the blocks' words with them."""

    def run(sent: pa.Table) -> pa.Table:
        sizes = [_unpack(x) for x in sent.column("sizes").to_pylist()]
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        data = pa.py_buffer(b"".join(map(_stretch, sent.column("words").to_pylist())))
        words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), data]).dictionary_encode()
        at, counts = words.indices.to_numpy(), _unpacked(sent, "counts")[0]
        c = np.bincount(at, weights=counts, minlength=len(words.dictionary)).astype(np.int64)
        seen = np.flatnonzero(c)
        seen = seen[pc.sort_indices(words.dictionary.take(pa.array(seen))).to_numpy()]
        places = np.full(len(c), -1, np.int64)
        places[seen] = np.arange(len(seen))
        part, ends = sent.column("part")[0].as_py(), np.cumsum([len(x) for x in sizes]).tolist()
        rows = [{"part": part, "c": _pack(c[seen]), "types": len(seen), "tokens": int(c.sum())}]
        for of, numbers, i, j in zip(sent.column("of").to_pylist(), sent.column("numbers").to_pylist(), [0, *ends], ends):
            rows.append({"part": part, "of": of, "places": _pack(places[at[i:j]], True), "c": _pack(c[at[i:j]]), "numbers": numbers})
        return _rows(_NUMBERED, rows)

    bounds = _bounds(table, p)
    held = cuts.cut(sent_words(table, bounds).groupBy("part").applyInArrow(run, _NUMBERED), "numbers")
    parts = held.where("of is null")
    types, tokens = np.zeros(len(bounds) + 2, np.int64), 0
    for r in parts.select("part", "types", "tokens").collect():  # one row per part
        types[r["part"] + 1], tokens = r["types"], tokens + r["tokens"]
    return Vocabulary(held.where("of is not null").select("part", "of", "places", "c", "numbers"), parts.select("part", "c"),
                      np.cumsum(types), int(types.sum()), tokens)


def _previous(numbers: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The word before each token; a text starts after an end."""
    out = np.empty_like(numbers)
    if len(numbers):
        out[1:] = numbers[:-1]
        out[np.cumsum(sizes) - sizes] = end
    return out


class _Block:
    """A block's tokens and its distinct pairs of known words, chunk by chunk in the order ``u, w``.

    Words go by their place in the sorted words of the block; a pair is the one number ``u * types + w`` of its ids.
    """

    def __init__(self, texts: pa.Table, found: pa.Table, starts: np.ndarray, chunks: int, p: Params):
        found = found.sort_by("part")
        self.places = [_unpack(x) for x in found.column("places").to_pylist()]
        ids = np.concatenate([np.where(x < 0, -1, x + starts[k]) for x, k in zip(self.places, found.column("part").to_pylist())])
        self.c, numbers = _unpacked(found, "c", "numbers")
        self.size, types = len(ids), int(starts[-1])
        rank = np.empty(self.size, np.int32)
        rank[numbers] = np.arange(self.size, dtype=np.int32)
        self.sizes = texts.column("sizes")[0].values.to_numpy().astype(np.int64)
        # A block's tokens are most of what a task holds: 32 bits for each (a block has far fewer words).
        self.own = rank[unpack_numbers(texts.column("refs")[0].as_py())]
        # Every text ends with an end.
        keys = _previous(self.own, self.sizes, self.own[-1]).astype(np.int64)
        keys *= self.size
        keys += self.own
        self.keys, at = np.unique(keys, return_inverse=True)
        del keys
        self.at = at.astype(np.int32)
        del at
        # Sorted by place, pairs are sorted by id.
        self.first = self.keys // self.size
        self.second = self.keys - self.first * self.size
        u, w = ids[self.first], ids[self.second]
        known = np.flatnonzero((u >= 0) & (w >= 0))
        u, w = u[known], w[known]
        # A word's pairs are dealt over as many chunks as it has chunks of tokens.
        salt = mix64(w.astype(np.uint64))
        salt %= (1 + self.c // p.chunk_tokens).astype(np.uint64)[self.first[known]]
        salt += mix64(u.astype(np.uint64))
        chunk = (mix64(salt) % np.uint64(chunks)).astype(np.uint16 if chunks < 1 << 16 else np.int64)
        del salt
        order = np.argsort(chunk, kind="stable")
        self.order, self.pairs = known[order], (u * types + w)[order]
        self.numbers, self.starts = np.unique(chunk[order], return_index=True)

    def parts(self):
        """(chunk, first and last place in the order) of every chunk the block has pairs of."""
        return zip(self.numbers.tolist(), self.starts.tolist(), [*self.starts[1:].tolist(), len(self.order)])


_PAIRS = "chunk long, of long, pairs binary, n binary"


def block_pairs(table: DataFrame, vocab: Vocabulary, chunks: int, p: Params) -> DataFrame:
    """``chunk, of, pairs, n`` (packed): a block's pairs of a chunk, and how often each is in texts that are not flagged."""
    starts = vocab.starts

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        b = _Block(texts, found, starts, chunks, p)
        train = np.repeat(~texts.column("flags")[0].values.to_numpy(zero_copy_only=False), b.sizes)
        n = np.bincount(b.at[train], minlength=len(b.keys))[b.order]
        of = texts.column("block")[0].as_py()
        return _rows(_PAIRS, [{"chunk": c, "of": of, "pairs": _pack(b.pairs[i:j], True), "n": _pack(n[i:j])} for c, i, j in b.parts()])

    parts = table.select("block", "sizes", "flags", "refs").groupBy("block").cogroup(vocab.numbered.groupBy("of"))
    return parts.applyInArrow(run, _PAIRS)


#: A chunk has one row of its pairs that move (``part`` is null) and sends a row to each part.
_STATE = ("chunk long, ids binary, a binary, b binary, n binary, t binary, kept binary, "
          "part long, places binary, opened binary, sent binary")
#: The first time, there is a row of all pairs too, and the sums of the pairs seen once.
_FIRST = (f"{_STATE}, pairs binary, all_n binary, ones long, twos long, places_once binary, opened_once binary, "
          "sent_once binary")


def _by_part(ids: np.ndarray, starts: np.ndarray):
    """(part, first and last place) of the sorted ids of each part."""
    ends = np.searchsorted(ids, starts).tolist()
    return [(k, i, j) for k, (i, j) in enumerate(zip(ends, ends[1:])) if j > i]


def _sums(ids: np.ndarray, a: np.ndarray, b: np.ndarray, t: np.ndarray) -> list[np.ndarray]:
    """By word, the tables opened in its restaurant, and sent to the root for it."""
    return [np.bincount(x, weights=t, minlength=len(ids)).astype(np.int64) for x in (a, b)]


def _state(chunk: int, ids, a, b, n, t, kept, starts) -> list[dict]:
    """A chunk's rows: its pairs (places of words in ``ids``, customers, tables, and tables summed over kept sweeps), and
    the sums by word for each part."""
    opened, sent = _sums(ids, a, b, t)
    return [{"chunk": chunk, "ids": _pack(ids, True), "a": _pack(a, True), "b": _pack(b), "n": _pack(n), "t": _pack(t),
             "kept": _pack(kept)}] + [
        {"chunk": chunk, "part": k, "places": _pack(ids[i:j] - starts[k], True), "opened": _pack(opened[i:j]),
         "sent": _pack(sent[i:j])} for k, i, j in _by_part(ids, starts)]


def _places(u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of pairs, and the places of the pairs' words in them."""
    ids, at = np.unique(np.concatenate([u, w]), return_inverse=True)
    return ids, at[:len(u)], at[len(u):]


def gathered(sent: DataFrame, vocab: Vocabulary) -> DataFrame:
    """The chunks from the blocks' pairs: all pairs, and those that move with one table each.

    A pair that was seen once has one table for good: what such pairs open and send is kept by word (``opened_once``,
    ``sent_once``), and only the other pairs, and their words, are part of the sweeps.
    """
    starts, types = vocab.starts, vocab.types

    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        pairs, n = _unpacked(table, "pairs", "n")
        pairs, n = pairs[n > 0], n[n > 0]
        order = np.argsort(pairs)
        pairs, n = pairs[order], n[order]
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        pairs, n = pairs[first], np.add.reduceat(n, first) if len(n) else n
        u = pairs // max(1, types)
        w = pairs - u * types
        ids, a, b = _places(u[n == 1], w[n == 1])
        opened, sent = _sums(ids, a, b, np.ones(len(a)))
        rows = [{"pairs": _pack(pairs, True), "all_n": _pack(n), "ones": int((n == 1).sum()), "twos": int((n == 2).sum())}]
        for k, i, j in _by_part(ids, starts):
            rows.append({"part": k, "places_once": _pack(ids[i:j] - starts[k], True), "opened_once": _pack(opened[i:j]),
                         "sent_once": _pack(sent[i:j])})
        ids, a, b = _places(u[n > 1], w[n > 1])
        one = np.ones(len(a), np.int64)
        rows += _state(chunk, ids, a, b, n[n > 1], one, 0 * one, starts)
        return _rows(_FIRST, [{**r, "chunk": chunk} for r in rows])

    return sent.groupBy("chunk").applyInArrow(run, _FIRST)


#: A part has one row of its words (``chunk`` is null) and answers each chunk with a row.
_WORDS = ("part long, c binary, opened binary, sent binary, r binary, opened_once binary, sent_once binary, "
          "roots array<binary>, opens array<binary>, guests long, root_tables long, ones long, twos long, opening double, "
          "logs double, chunk long")
_KEPT = ("part", "c", "opened_once", "sent_once", "roots", "opens")


def _digamma(x: np.ndarray) -> np.ndarray:
    y = x + 6
    return np.log(y) - 1 / (2 * y) - 1 / (12 * y * y) + 1 / (120 * y * y * y * y) - sum(1 / (x + i) for i in range(6))


def _auxiliary(now: float, discount: float, c: np.ndarray, t: np.ndarray) -> tuple[float, float]:
    """What restaurants with ``c`` customers at ``t`` tables say of the strength: sums of the means of the usual auxiliary
    variables, rounded, so that the order of a sum over parts does not show."""
    c, t = c[(c > 0) & (t > 0)].astype(float), t[(c > 0) & (t > 0)].astype(float)
    ratio = now / discount
    opening = ratio * (_digamma(ratio + t) - _digamma(np.array(ratio + 1)))
    logs = _digamma(now + c) - _digamma(np.array(now + 1.0))
    return float(np.round(opening, 6).sum()), float(np.round(logs, 6).sum())


def _strength(opening: float, logs: float) -> float:
    """A strength's next value from the sums of ``_auxiliary``, with a gamma(1, 1) prior."""
    return round(max(0.01, (1 + opening) / max(0.01, 1 + logs)), 4)


def _words(part: int, c, opened, sent, r, totals: dict, replies: list[tuple[int, np.ndarray]], **kept) -> pa.Table:
    """A part's row, and what it answers each chunk: the sums of the words that the chunk asked for, in its order."""
    opening, logs = _auxiliary(totals["strength"], totals["discount"], c, opened)
    rows = [{"part": part, "c": _pack(c), "opened": _pack(opened), "sent": _pack(sent), "r": _pack(r),
             "guests": int(sent.sum()), "root_tables": int(r.sum()), "ones": int((sent == 1).sum()),
             "twos": int((sent == 2).sum()), "opening": opening, "logs": logs, **kept}]
    for chunk, at in replies:
        rows.append({"part": part, "chunk": chunk, "opened": _pack(opened[at]), "sent": _pack(sent[at]), "r": _pack(r[at])})
    return _rows(_WORDS, rows)


def _added(table: pa.Table, names: tuple, opened: np.ndarray, sent: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Adds up what the chunks opened and sent; the places that each chunk named."""
    asked = []
    rows = table.select(["chunk", *names]).filter(table.column(names[0]).is_valid())
    for chunk, at, x, y in zip(*(rows.column(c).to_pylist() for c in rows.column_names)):
        at = _unpack(at)
        opened[at] += _unpack(x)
        sent[at] += _unpack(y)
        asked.append((chunk, at))
    return asked


def first_words(vocab: Vocabulary, chunks: DataFrame, totals: dict) -> DataFrame:
    """The parts with the sums over the chunks' pairs, one table each, and one table of the root for each word."""

    def run(held: pa.Table, sums: pa.Table) -> pa.Table:
        c = _unpack(held.column("c")[0].as_py())
        opened, sent = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
        _added(sums, ("places_once", "opened_once", "sent_once"), opened, sent)
        once = {"opened_once": _pack(opened), "sent_once": _pack(sent), "roots": [], "opens": []}
        asked = _added(sums, ("places", "opened", "sent"), opened, sent)
        return _words(held.column("part")[0].as_py(), c, opened, sent, np.ones(len(c), np.int64), totals, asked, **once)

    sums = chunks.where("part is not null").select(
        "chunk", "part", "places", "opened", "sent", "places_once", "opened_once", "sent_once")
    return vocab.parts.groupBy("part").cogroup(sums.groupBy("part")).applyInArrow(run, _WORDS)


def reseat(u, w, n, t, opened, sent, r, totals: dict, p: Params, turn: int) -> np.ndarray:
    """One pass over a chunk's pairs; ``opened, sent, r`` are arrays by place of a word (``u, w`` are such places).

    ``totals["ids"]`` has the ids of the places. A pair that was seen once has one table and never moves.
    """
    d1, d0, t1, t0 = (totals[x] for x in ("discount", "root_discount", "strength", "root_strength"))
    base = (t0 + d0 * totals["root_tables"]) / (totals["types"] + 1)
    t, opened, sent, guests = t.copy(), opened.astype(float), sent.astype(float), float(totals["guests"])
    moving = np.flatnonzero(n > 1)
    if not len(moving):
        return t
    ids = totals["ids"]
    # Pairs are sorted by u: a context's pairs take their steps in turn, each context beginning at another one.
    mu = u[moving]
    first = np.concatenate([[True], mu[1:] != mu[:-1]])
    rank = np.arange(len(mu)) - np.maximum.accumulate(np.where(first, np.arange(len(mu)), 0))
    step = (rank + ids[mu] + turn) % p.steps
    for s in range(p.steps):
        at = moving[step == s]
        if not len(at):
            continue
        old, a, b = t[at], u[at], w[at]
        rest = np.maximum(sent[b] - old, 0)
        parent = rest - d0 * np.minimum(r[b], rest) + base
        new = seating.tables(n[at], old, t1 + d1 * np.maximum(opened[a] - old, 0), d1, parent, t0 + guests - old, 1,
                             lambda i, rows: seating.uniform(p.seed, turn, i, ids[a[rows]], ids[b[rows]]))
        np.add.at(opened, a, new - old)
        np.add.at(sent, b, new - old)
        guests += float((new - old).sum())
        t[at] = new
    return t


def sweep(state: DataFrame, words: DataFrame, vocab: Vocabulary, totals: dict, p: Params, turn: int) -> DataFrame:
    """Every pair's tables drawn anew, with the sums that the parts answered."""
    keep, starts = turn > p.burn_in, vocab.starts

    def run(held: pa.Table, answers: pa.Table) -> pa.Table:
        ids, a, b, n, t, kept = _unpacked(held, "ids", "a", "b", "n", "t", "kept")
        # Parts are ranges of ids: their answers, one after another, are in the order of the chunk's ids.
        opened, sent, r = _unpacked(answers.sort_by("part"), "opened", "sent", "r")
        t = reseat(a, b, n, t, opened, sent, r, {**totals, "ids": ids}, p, turn)
        return _rows(_STATE, _state(held.column("chunk")[0].as_py(), ids, a, b, n, t, kept + t if keep else kept, starts))

    held = state.where("ids is not null").select("chunk", "ids", "a", "b", "n", "t", "kept")
    answers = words.where("chunk is not null").select("chunk", "part", "opened", "sent", "r")
    return held.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, _STATE)


def seat_root(words: DataFrame, state: DataFrame, vocab: Vocabulary, totals: dict, p: Params, turn: int) -> DataFrame:
    """The parts with the sums after a sweep, and the root's tables drawn anew; kept sweeps add to ``roots`` and ``opens``."""
    keep, d0, t0 = turn > p.burn_in, totals["root_discount"], totals["root_strength"]
    root_tables, types, starts = float(totals["root_tables"]), totals["types"], vocab.starts

    def drawn(ids, sent, old):
        old, zero = np.minimum(old, sent), np.zeros(len(ids), np.int64)
        return seating.tables(sent, old, t0 + d0 * (root_tables - old), d0, np.full(len(ids), 1.0),
                              np.full(len(ids), types + 1.0), 0,
                              lambda i, rows: seating.uniform(p.seed + 1, turn, i, ids[rows], zero[rows]))

    def run(held: pa.Table, sums: pa.Table) -> pa.Table:
        part, kept = held.column("part")[0].as_py(), {c: held.column(c)[0].as_py() for c in _KEPT[2:]}
        c, opened, sent, r = _unpacked(held, "c", "opened_once", "sent_once", "r")
        asked = _added(sums, ("places", "opened", "sent"), opened, sent)
        r = drawn(np.arange(starts[part], starts[part] + len(c)), sent, r)
        if keep:
            kept["roots"] = [*kept["roots"], _pack(sent), _pack(r)]
            kept["opens"] = [*kept["opens"], _pack(opened)]
        return _words(part, c, opened, sent, r, totals, asked, **kept)

    sums = state.where("part is not null").select("chunk", "part", "places", "opened", "sent")
    held = words.where("chunk is null").select(*_KEPT, "r")
    return held.groupBy("part").cogroup(sums.groupBy("part")).applyInArrow(run, _WORDS)


def _discount(ones: int, twos: int) -> float:
    """Leave-one-out estimate from the numbers of dishes with one and with two customers."""
    return round(min(0.95, max(0.05, ones / (ones + 2 * twos))), 4) if ones else 0.5


def _filled(n: np.ndarray, moving: np.ndarray, once: int) -> np.ndarray:
    """Values of all pairs from those of the pairs that move; ``once`` for the pairs seen once."""
    out = np.full(len(n), once, np.int64)
    out[n > 1] = moving
    return out


@dataclass
class Fitted:
    """The written model: per word its root customers and its restaurant's tables; per pair its discounted customers."""

    parts: DataFrame  # the parts of the vocabulary; roots, opens: of each kept sweep
    seats: DataFrame  # the chunks: all pairs
    moving: DataFrame  # the chunks: the pairs that move
    vocab: Vocabulary
    chunks: int
    params: Params
    contexts: range  # a context is the id of the previous word
    discount: float
    strength: float
    root_discount: float
    base: np.ndarray  # (kept sweeps): what the base adds to a word's discounted customers at the root
    guests: np.ndarray  # (kept sweeps): what the sum is divided by

    @property
    def state(self) -> DataFrame:
        """The chunks' pairs that move."""
        return self.moving.where("ids is not null")

    @property
    def ids(self) -> DataFrame:
        """``id, c, opened, sent, r, roots, opens``: a row per word; for looking at small models."""
        starts, d0 = self.vocab.starts, self.root_discount

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    c, opened, sent, r = (_unpack(row[x]) for x in ("c", "opened", "sent", "r"))
                    roots, opens = ([_unpack(x) for x in row[x]] for x in ("roots", "opens"))
                    roots = [x - d0 * y for x, y in zip(roots[::2], roots[1::2])]
                    lists = [list(map(list, zip(*x))) if x else [[]] * len(c) for x in (roots, opens)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(starts[row["part"]] + np.arange(len(c))), *map(pa.array, (c, opened, sent, r)),
                         pa.array(lists[0], pa.list_(pa.float64())), pa.array(lists[1], pa.list_(pa.int64()))],
                        names=["id", "c", "opened", "sent", "r", "roots", "opens"])

        held = self.parts.where("chunk is null").select("part", "c", "opened", "sent", "r", "roots", "opens")
        return held.mapInArrow(run, "id long, c long, opened long, sent long, r long, roots array<double>, opens array<long>")

    @property
    def pairs(self) -> DataFrame:
        """``u, w, n, t, kept``: a row per pair; for looking at small models."""
        sweeps, types = len(self.guests), self.vocab.types

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    pairs, n = _unpack(row["pairs"]), _unpack(row["all_n"])
                    yield pa.RecordBatch.from_pydict({"u": pairs // types, "w": pairs % types, "n": n,
                                                      "t": _filled(n, _unpack(row["t"]), 1),
                                                      "kept": _filled(n, _unpack(row["kept"]), sweeps)})

        held = self.seats.where("pairs is not null").select("chunk", "pairs", "all_n").join(
            self.state.select("chunk", "t", "kept"), "chunk")
        return held.select("pairs", "all_n", "t", "kept").mapInArrow(run, "u long, w long, n long, t long, kept long")

    @property
    def words(self) -> DataFrame:
        """For looking at small models: ``id, roots``, and the word's contexts with their gains, summed over kept sweeps."""
        mass = F.col("n") * len(self.guests) - self.discount * F.col("kept")
        each = self.pairs.join(self.ids.select(F.col("id").alias("u"), "c"), "u").select(
            "u", F.col("w").alias("id"), (mass / (self.strength + F.col("c"))).alias("gain"))
        per = each.groupBy("id").agg(F.collect_list(F.struct("u", "gain")).alias("x"))
        return self.ids.join(per, "id").select("id", "roots", F.col("x.u").alias("contexts"), F.col("x.gain").alias("gain"))

    @property
    def back(self) -> np.ndarray:
        """For looking at small models: the weight of the root in each context, (kept sweeps, contexts)."""
        rows = sorted((r["id"], r["c"], r["opens"]) for r in self.ids.select("id", "c", "opens").collect())
        return np.array([[(self.strength + self.discount * t) / (self.strength + c) for t in opens]
                         for _, c, opens in rows]).T


def _chunks(tokens: int, p: Params) -> int:
    return 1 + tokens // p.chunk_tokens


def fit(table: DataFrame, cuts: TableCuts, p: Params = Params()) -> Fitted:
    """Fit the model on the rows of a written block table that are not flagged."""
    vocab = vocabulary(table, cuts, p)
    pairs = cuts.cut(block_pairs(table, vocab, _chunks(vocab.tokens, p), p), "block-pairs")
    return fit_pairs(pairs, vocab, cuts, p)


def fit_pairs(pairs: DataFrame, vocab: Vocabulary, cuts: TableCuts, p: Params) -> Fitted:
    """Fit the model on written pairs of blocks."""
    state = seats = cuts.cut(gathered(pairs, vocab), "seats")
    seen = seats.agg(F.sum("ones"), F.sum("twos")).first()
    totals = {"types": vocab.types, "discount": _discount(seen[0] or 0, seen[1] or 0), "strength": 1.0, "root_strength": 1.0}
    words = cuts.cut(first_words(vocab, seats, totals), "words-0")

    def count(fitting: bool):
        names = ("guests", "root_tables", "ones", "twos", "opening", "logs")
        guests, tables, ones, twos, *sums = (x or 0 for x in words.where("chunk is null").agg(*map(F.sum, names)).first())
        totals["guests"], totals["root_tables"] = guests, tables
        if fitting:
            totals["root_discount"] = _discount(ones, twos)
            totals["strength"] = _strength(*sums)
            totals["root_strength"] = _strength(*_auxiliary(
                totals["root_strength"], totals["root_discount"], np.array([guests]), np.array([tables])))

    count(True)
    base, guests = [], []
    for turn in range(1, p.sweeps + 1):
        state = cuts.cut(sweep(state, words, vocab, totals, p, turn), f"seats-{turn}")
        if turn > 1:
            cuts.drop(f"{cuts.root}/seats-{turn - 1}")
        words = cuts.cut(seat_root(words, state, vocab, totals, p, turn), f"words-{turn}")
        cuts.drop(f"{cuts.root}/words-{turn - 1}")
        count(turn < p.burn_in)
        if turn > p.burn_in:
            # With the totals after the sweep, the probabilities of each context add up to one.
            base.append((totals["root_strength"] + totals["root_discount"] * totals["root_tables"]) / (vocab.types + 1))
            guests.append(totals["root_strength"] + totals["guests"])
    return Fitted(words, seats, state, vocab, _chunks(vocab.tokens, p), p, range(vocab.types), totals["discount"],
                  totals["strength"], totals["root_discount"], np.array(base), np.array(guests))


def block_gains(pairs: DataFrame, model: Fitted) -> DataFrame:
    """``of, chunk, n, tables`` (packed): for a block's pairs of a chunk, in their order, the customers, and the tables
    summed over kept sweeps."""
    sweeps = len(model.guests)
    kind = "of long, chunk long, n binary, tables binary"

    def run(sent: pa.Table, held: pa.Table) -> pa.Table:
        keys, n, moving = _unpacked(held.filter(held.column("pairs").is_valid()), "pairs", "all_n") + _unpacked(
            held.filter(held.column("kept").is_valid()), "kept")
        # Pairs that were not seen in training are found at the end, with no customers and no tables.
        tables, n, keys = (np.append(x, y) for x, y in ((_filled(n, moving, sweeps), 0), (n, 0), (keys, -1)))
        out = []
        for of, chunk, asked in zip(*(sent.column(c).to_pylist() for c in ("of", "chunk", "pairs"))):
            asked = _unpack(asked)
            at = np.searchsorted(keys[:-1], asked)
            at[keys[at] != asked] = len(keys) - 1
            out.append({"of": of, "chunk": chunk, "n": _pack(n[at]), "tables": _pack(tables[at])})
        return _rows(kind, out)

    none = F.lit(None).cast("binary")
    held = model.seats.where("pairs is not null").select("chunk", "pairs", "all_n", none.alias("kept")).unionByName(
        model.state.select("chunk", none.alias("pairs"), none.alias("all_n"), "kept"))
    parts = pairs.select("chunk", "of", "pairs").groupBy("chunk").cogroup(held.groupBy("chunk"))
    return parts.applyInArrow(run, kind)


def block_words(model: Fitted) -> DataFrame:
    """The vocabulary's ``numbered`` rows with ``kept`` (packed): of a block's words of a part, in their order, and each
    kept sweep the customers and tables of the root and the tables of the word's restaurant, one after another."""
    sweeps = len(model.guests)
    kind = "of long, part long, places binary, c binary, numbers binary, kept binary"

    def run(sent: pa.Table, held: pa.Table) -> pa.Table:
        roots, opens = (list(map(_unpack, held.column(c)[0].as_py())) for c in ("roots", "opens"))
        # By word and sweep, differences between sweeps; the last row is that of words not seen in training.
        kept = np.stack([*roots[::2], *roots[1::2], *opens])
        kept = np.diff(kept.reshape(3, sweeps, kept.shape[1]), axis=1, prepend=0).reshape(kept.shape)
        kept = np.pad(kept, ((0, 0), (0, 1)))
        out = [{**row, "kept": _pack(kept[:, _unpack(row["places"])].reshape(-1))} for row in sent.to_pylist()]
        return _rows(kind, out)

    held = model.parts.where("chunk is null").select("part", "roots", "opens")
    parts = model.vocab.numbered.groupBy("part").cogroup(held.groupBy("part"))
    return parts.applyInArrow(run, kind)


def score(table: DataFrame, gains: DataFrame, model: Fitted) -> DataFrame:
    """``key, n_tokens, n_known, base_score, score`` for every text of a block table.

    A block's words fetch what the model has of them; texts, words and the
    gains of the block's pairs (``block_gains``) meet by block.
    """
    tokens, types, from_base, guests = model.vocab.tokens, model.vocab.types, model.base, model.guests
    kept, strength, discount, d0 = len(guests), model.strength, model.discount, model.root_discount
    starts, chunks, params = model.vocab.starts, model.chunks, model.params
    kind = table.schema["keys"].dataType.elementType.simpleString()

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        words, sent = (found.filter(found.column(c).is_valid()).sort_by(c) for c in ("part", "chunk"))
        b = _Block(texts, words, starts, chunks, params)
        size, c = b.size, b.c
        mass = np.zeros(len(b.keys))
        n, tables = _unpacked(sent, "n", "tables")
        mass[b.order] = (n - discount * tables / kept).astype("<f4")
        held = np.concatenate([_unpack(x).reshape(3, kept, -1) for x in words.column("kept").to_pylist()], axis=2)
        customers, seats, opens = np.cumsum(held, axis=1).astype(float)
        roots = ((customers - d0 * seats).T + from_base) / guests
        back = (strength + discount * opens.T) / (strength + c)[:, None]
        # Pairs, not tokens, are worked out.
        p = mass / (strength + c)[b.first]
        for s in range(kept):
            p += back[:, s][b.first] * roots[:, s][b.second] / kept
        begins = np.cumsum(b.sizes) - b.sizes
        base = np.log10((c + 0.5) / (tokens + 0.5 * (types + 1)))
        total = lambda x: np.add.reduceat(x, begins)  # noqa: E731  every text has its end token
        return pa.table({
            "key": texts.column("keys")[0].values, "n_tokens": b.sizes,
            "n_known": total((c > 0).astype(np.int64)[b.own]), "base_score": total(base[b.own]),
            "score": total(np.log10(p)[b.at])})

    found = block_words(model).unionByName(gains, allowMissingColumns=True)
    parts = table.select("block", "keys", "sizes", "refs").groupBy("block").cogroup(found.groupBy("of"))
    return parts.applyInArrow(run, f"key {kind}, n_tokens long, n_known long, base_score double, score double")


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params(),
                    cuts: TableCuts | None = None) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Rows whose key (as text) has a crc32 of 1 modulo 5 are held out; the model
    learns from all others. ``score`` is the model's log10 probability of the
    text, an end included, ``base_score`` that of a smoothed unigram model. A
    null text is an empty one: its end is its only token. Without training
    rows every word is the unknown one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    cuts = cuts or TableCuts(spark, "pitman-yor", release_shuffles=True)
    flag = F.coalesce(id_remainder(F.col(key), 5) == 1, F.lit(False))
    rows = docs.select(F.col(key).alias("key"), flag.alias("flag"), F.col(text).alias("text"))
    table = cuts.cut(blocks(rows, fold=True, end=True, block_bytes=params.block_bytes), "blocks", compression="zstd")
    vocab = vocabulary(table, cuts, params)
    pairs = cuts.cut(block_pairs(table, vocab, _chunks(vocab.tokens, params), params), "block-pairs")
    model = fit_pairs(pairs, vocab, cuts, params)
    gains = cuts.cut(block_gains(pairs, model), "gains")
    # Only the words of the model are needed from here on.
    for name in ("block-pairs", "seats", f"seats-{params.sweeps}"):
        cuts.drop(f"{cuts.root}/{name}")
    out = score(table, gains, model)
    return out.select(F.col("key").alias(key), (id_remainder(F.col("key"), 5) == 1).alias("held_out"), "n_tokens",
                      "n_known", F.lit(vocab.tokens).cast("long").alias("train_tokens"), "base_score", "score")
