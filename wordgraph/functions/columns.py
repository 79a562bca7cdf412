"""Column expressions shared by the operators (all JVM-side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results:
# white space separates the fields of an edge line, PageRank starts every
# rank at 1.0 and updates it as 0.15 + 0.85 * (sum of contributions).
FIELD_SEPARATOR = r"\s+"
INITIAL_RANK = 1.0
RESET = 0.15
DAMPING = 0.85

# Token rule of the document fixture: lower case, split at anything that is not
# a-z, U+00E0..U+00FF or a digit, empty parts dropped. The same tokens are the
# maximal runs of DOC_TOKEN, which is how they are extracted (one regex pass,
# no empty parts, about twice as fast as splitting on the complement class).
DOC_TOKEN = "[a-zà-ÿ0-9]+"

EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def fields(line: Column | str) -> Column:
    """split a text line at runs of white space."""
    c = F.col(line) if isinstance(line, str) else line
    # White space at the end makes no empty last field.
    return F.split(F.regexp_replace(c, FIELD_SEPARATOR + "$", ""), FIELD_SEPARATOR)


def interval_seconds(every: str) -> int:
    """Seconds of an interval written like ``15 minutes`` or ``1 day``."""
    n, unit = every.split() if " " in every else ("1", every)
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def interval_number(ts: Column | str, every: str = "1 hour", zoned: bool = False) -> Column:
    """Number of the interval since 1970-01-01 that a timestamp falls in, rounded down (also before 1970).

    A zone-free timestamp counts as it is written, a zoned one as its instant.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    micros = F.unix_micros(c) if zoned else F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), c)
    return F.floor(micros / F.lit(interval_seconds(every) * 1_000_000)).cast("bigint")


def hour_key(ts: Column | str) -> Column:
    """Whole hours since 1970-01-01 for a timestamp without zone.

    ``timestampdiff`` keeps the value zone-free; ``date_trunc`` would turn it
    into a zoned timestamp and shift it by the session zone.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("HOUR", F.expr(EPOCH_NTZ), c)


def doc_tokens(text: Column | str, token: str = DOC_TOKEN) -> Column:
    """Array of the tokens of a whole text: every maximal match of ``token`` in its lower case."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(token), 0)


def rank_update(contribution: Column, reset: float = RESET, damping: float = DAMPING) -> Column:
    """``reset + damping * contribution``."""
    return F.lit(reset) + F.lit(damping) * contribution


def truncated_div(total: str, n: str) -> Column:
    """``total div n`` on integers (truncated towards zero), widened to float."""
    return F.expr(f"cast(`{total}` div `{n}` as float)")


def placement_part(strategy: str, n: int, src: str = "src", dst: str = "dst") -> Column:
    """The edge part under a placement rule, as a plain column.

    grid: a rows x cols grid with rows * cols = n, rows >= cols, cell
    ``pmod(src, rows) * cols + pmod(dst, cols)``; src: ``pmod(src, n)``;
    pair: ``pmod(src * 31 + dst, n)``; mod: ``pmod(src, n)`` (used on
    distinct edges, the adjacency placement of the drop form).
    Plain arithmetic keeps the rule repeatable in SQL; ids are bigint.
    """
    s, d = F.col(src), F.col(dst)
    if strategy == "grid":
        rows, cols = grid_shape(n)
        return (F.pmod(s, F.lit(rows)) * cols + F.pmod(d, F.lit(cols))).cast("int")
    if strategy in ("src", "mod"):
        return F.pmod(s, F.lit(n)).cast("int")
    if strategy == "pair":
        # In decimal(38, 0): the same value as bigint arithmetic where that
        # does not overflow, and no overflow error (ANSI) for large ids.
        wide = s.cast("decimal(38,0)") * 31 + d.cast("decimal(38,0)")
        return F.pmod(wide, F.lit(n)).cast("int")
    raise ValueError(f"unknown placement {strategy!r}")


def grid_shape(n: int) -> tuple[int, int]:
    """Rows and columns of the most square grid with rows * cols = n."""
    cols = int(n**0.5)
    while n % cols:
        cols -= 1
    return n // cols, cols
