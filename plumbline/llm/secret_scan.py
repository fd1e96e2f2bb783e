"""Secrets in texts: fixed patterns, and windows of high entropy.

Everything is built-in column expressions.  A pattern's matches and the gaps
between them (``split`` by the same pattern) give positions in code points.
Candidate strings of one character class are slid over by a window; its
Shannon entropy is kept by incremental counts, one character in and one out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed patterns; a match is dropped if the part in question is too short
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 6
#: runs of one class are whole matches, so the least length can stand in the pattern
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

#: order of kinds in the list of spans
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")


@dataclass(frozen=True)
class CharacterClass:
    """Candidates of one class: their pattern, alphabet, window and least entropy in bits."""

    kind: str
    pattern: str
    alphabet: str
    window: int
    least_bits: float


CLASSES = (
    CharacterClass("entropy_hex", r"[0-9A-Fa-f]{32,}", "0123456789abcdefABCDEF", 32, 3.2),
    CharacterClass(
        "entropy_base64",
        r"[A-Za-z0-9+/_-]{24,}={0,2}",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=",
        24,
        3.9,
    ),
)
#: candidates that are no secrets: identifiers, samples, runs of the alphabet, words without digits
ALLOWED = (
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Xx]{6}",
    r"0123456789|[Aa][Bb][Cc][Dd][Ee][Ff][Gg][Hh]",
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
)


def _located(text: Column, pattern: str) -> Column:
    """Matches from the left as array of (start, value), positions in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("value"))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,value:string>>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["gap"])
        one = F.array(F.struct(start.alias("start"), x["value"].alias("value")))
        return F.struct(
            (start + F.coalesce(F.char_length(x["value"]), F.lit(0))).alias("at"),
            F.when(x["value"].isNull(), state["out"]).otherwise(F.concat(state["out"], one)).alias("out"),
        )

    return F.aggregate(steps, begin, step, lambda s: s["out"])


def _spans(text: Column, kind: str, pattern: str, keep=None) -> Column:
    order = KINDS.index(kind)
    matches = _located(text, pattern)
    if keep is not None:
        matches = F.filter(matches, lambda m: keep(m["value"]))
    spans = F.transform(
        matches,
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(order).alias("kind"),
            (m["start"] + F.char_length(m["value"])).alias("stop"),
        ),
    )
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<start:int,kind:int,stop:int>>"))


def _entropy_extent(value: Column, c: CharacterClass) -> Column:
    """(first, last): the first and the last end of windows with enough entropy, 0 if none.

    With counts n of the window's W characters the entropy is
    log2(W) - sum(n log2 n) / W, so only that sum is carried along.
    """
    letters = F.split(value, "")
    weight = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(c.window + 1)])
    most = F.lit(c.window * (math.log2(c.window) - c.least_bits))
    begin = F.struct(
        F.array_repeat(F.lit(0), len(c.alphabet)).alias("n"),
        F.lit(0.0).alias("sum"),
        F.lit(0).alias("first"),
        F.lit(0).alias("last"),
    )

    def step(s: Column, i: Column) -> Column:
        into = F.instr(F.lit(c.alphabet), F.element_at(letters, i))
        full = i > c.window
        out = F.when(full, F.instr(F.lit(c.alphabet), F.element_at(letters, F.greatest(i - c.window, F.lit(1))))).otherwise(0)
        n_in, same = F.element_at(s["n"], into), into == out
        n_out = F.element_at(s["n"], F.greatest(out, F.lit(1)))
        at = lambda n: F.element_at(weight, n + 1)
        total = (
            s["sum"]
            + F.when(same, 0.0).otherwise(at(n_in + 1) - at(n_in))
            + F.when(full & ~same, at(F.greatest(n_out - 1, F.lit(0))) - at(n_out)).otherwise(0.0)
        )
        counts = F.transform(
            s["n"], lambda n, k: n + F.when(k + 1 == into, 1).otherwise(0) - F.when(k + 1 == out, 1).otherwise(0)
        )
        hit = (i >= c.window) & (total <= most)
        return F.struct(
            counts.alias("n"),
            total.alias("sum"),
            F.when(hit & (s["first"] == 0), i).otherwise(s["first"]).alias("first"),
            F.when(hit, i).otherwise(s["last"]).alias("last"),
        )

    state = F.aggregate(F.sequence(F.lit(1), F.char_length(value)), begin, step)
    return state


def _entropy_spans(text: Column, c: CharacterClass) -> Column:
    none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    allowed = lambda v: ~F.coalesce(F.reduce(
        F.array(*[v.rlike(p) for p in ALLOWED]), F.lit(False), lambda a, b: a | b), F.lit(False))
    found = F.filter(_located(text, c.pattern), lambda m: allowed(m["value"]))
    sized = F.transform(found, lambda m: F.struct(m["start"].alias("start"), _entropy_extent(m["value"], c).alias("e")))
    spans = F.transform(
        F.filter(sized, lambda m: m["e"]["first"] > 0),
        lambda m: F.struct(
            (m["start"] + m["e"]["first"] - c.window).alias("start"),
            F.lit(KINDS.index(c.kind)).alias("kind"),
            (m["start"] + m["e"]["last"]).alias("stop"),
        ),
    )
    return F.when(text.rlike(c.pattern), spans).otherwise(none)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the column ``secret_spans``: array of (start, kind, stop), in order.

    Null text counts as empty, and an empty text has no spans.  Every row is
    treated by itself: repeated rows repeat their spans, an empty table stays
    empty, other columns pass through, and a column ``secret_spans`` that is
    already there is replaced.  Texts of any length are scanned whole.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    value = lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_LEAST
    kinds = [
        _spans(whole, "assign", ASSIGN, value),
        _spans(whole, "access", ACCESS),
        _spans(whole, "hex", HEX),
        *[_entropy_spans(whole, c) for c in CLASSES],
    ]
    return docs.withColumn("secret_spans", F.array_sort(F.concat(*kinds)))


def digests(scanned: DataFrame) -> DataFrame:
    """Counts, the digest of the fixed kinds and the list of all spans, per row of ``scan``."""
    spans = F.col("secret_spans")
    names = F.array(*[F.lit(k) for k in KINDS])

    def listed(these: Column) -> Column:
        return F.array_join(
            F.transform(
                these,
                lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")),
            ),
            ",",
        )

    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(F.filter(spans, lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of the text replaced by ``mask`` and ``n_chars`` set anew.

    Overlapping spans give one mask.  Rows without spans stay as they are.
    """
    scanned = scan(docs)
    text = F.col("text")
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        more = F.substring(text, s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0)))
        return F.struct(
            F.greatest(s["at"], x["stop"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(s["out"], more, F.when((x["start"] > s["at"]) | (s["at"] == 0), F.lit(mask)).otherwise(F.lit(""))))
            .otherwise(s["out"])
            .alias("out"),
        )

    masked = F.aggregate(
        F.col("secret_spans"), begin, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.char_length(text)))
    )
    some = F.size("secret_spans") > 0
    out = scanned.withColumn("_masked", F.when(some, masked))
    return out.select(
        *[
            F.when(some, F.col("_masked")).otherwise(text).alias("text")
            if c == "text"
            else F.when(some, F.char_length("_masked").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
            if c == "n_chars"
            else F.col(c)
            for c in docs.columns
        ]
    )
