"""Secret scan with Spark's own functions only.

Base patterns (fixed values) find assignments, access keys and hex runs. The entropy scan adds
to them: candidate strings over the base64 alphabet are read with a sliding window, whose
Shannon entropy is kept by incremental counts. With ``c`` copies of a symbol among ``w``, the
entropy is ``log2(w) - sum(c * log2 c) / w``, so a step of the window changes two terms.
Each character class has its own threshold, and allow-listed shapes and contexts (UUIDs, plain
words, paths and links, values announced as checksums) are suppressed.

Positions are code points, ends exclusive. NULL and empty texts have no spans. Every row gives
one row; repeated rows repeat.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns. Kinds sort in this order where starts are equal.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LEAST = 12
# A run that is too short for its kind is maximal, so the length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

#: Candidates of the entropy scan and their window, in characters.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# Bits per symbol from which a window counts, by the class of the candidate: hex digits, one
# case with digits, or both cases with digits.
BITS = {"hex": 3.1, "single_case": 3.55, "mixed": 3.85}
# Allow-list: whole candidates, and what may stand right before one.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
    r"|^[A-Za-z=_/+-]*$|^[0-9=_/+-]*$|^[A-Za-z]*[-_]?[0-9]{1,4}$"
)
ALLOWED_BEFORE = r"(?i)((sha-?(1|256|512)|md5|checksum|digest|etag)[:=\-]|https?:/?/?|www\.)$"
BEFORE = 12
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
REDACTED = "[secret]"
#: Numbers that one fold appends, and spans that one part of a text holds.
RUN = 128
SCALE = 1_000_000  # entropies are summed in whole millionths, so that no rounding adds up


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(numbers: Column) -> Column:
    """The sum up to each place of ``numbers``, itself included.

    A fold that appends copies its array at every step, so sums run over blocks of ``RUN`` numbers
    and once over the blocks' totals.
    """

    def sums(values: Column) -> Column:
        start = F.array(F.lit(0).cast("bigint"))
        grown = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
        return F.aggregate(values, start, grown)

    def joined(blocks: Column, before: Column) -> Column:
        return F.flatten(
            F.transform(
                blocks,
                lambda block, k: F.transform(F.slice(block, 2, RUN), lambda x: x + F.get(before, k)),
            )
        )

    def split(values: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int"))
        blocks = F.transform(at, lambda k: sums(F.slice(values, k * RUN + 1, F.lit(RUN))))
        totals = lambda made: sums(F.transform(made, lambda block: F.element_at(block, -1)))
        return _let(blocks, lambda made: _let(totals(made), lambda before: joined(made, before)))

    none = F.array().cast("array<bigint>")
    return _let(numbers.cast("array<bigint>"), lambda v: F.when(F.size(v) > 0, split(v)).otherwise(none))


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches as ``(begin, kind, end, match, before)``.

    Splitting by the pattern gives the gaps; the lengths of gaps and matches sum up to positions.
    """
    none = F.array().cast("array<struct<begin:int,kind:int,end:int,match:string,before:string>>")
    pairs = F.filter(
        F.arrays_zip(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
            F.split(text, pattern, -1).alias("g"),
        ),
        lambda p: p["m"].isNotNull(),
    )

    def span(p: Column, end: Column) -> Column:
        return F.struct(
            (end - F.char_length(p["m"])).cast("int").alias("begin"),
            F.lit(kind).alias("kind"),
            end.cast("int").alias("end"),
            p["m"].alias("match"),
            F.right(p["g"], F.lit(BEFORE)).alias("before"),
        )

    def placed(found: Column) -> Column:
        lengths = F.transform(found, lambda p: F.char_length(p["g"]) + F.char_length(p["m"]))
        return F.zip_with(found, _running(lengths), span)

    return F.when(text.rlike(pattern), _let(pairs, placed)).otherwise(none)


def terms() -> list[int]:
    """``c * log2(c)`` for the counts that a window can hold, in millionths."""
    return [round(c * math.log2(c) * SCALE) if c else 0 for c in range(WINDOW + 1)]


def most_repetition(bits: float) -> int:
    """The sum of terms up to which a window's entropy is ``bits`` or more."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * SCALE)


def _hot(candidate: Column, limit: Column) -> Column:
    """``(first, last)`` ends of the windows of high entropy in ``candidate``, 0 for none.

    The fold runs over (came, went) symbols of each step, made once before it starts.
    """
    symbols = F.filter(
        F.transform(F.split(candidate, ""), lambda ch: F.instr(F.lit(ALPHABET), ch)), lambda i: i > 0
    )
    gone = F.concat(F.array_repeat(F.lit(0), WINDOW), F.slice(symbols, 1, F.char_length(candidate) - WINDOW))
    steps = F.arrays_zip(symbols.alias("came"), gone.alias("went"))
    term = F.array(*[F.lit(t).cast("bigint") for t in terms()])
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.lit(0).cast("bigint").alias("sum"),
        limit.alias("limit"),
        F.lit(0).alias("at"),
        F.lit(0).alias("first"),
        F.lit(0).alias("last"),
    )

    def step(acc: Column, x: Column) -> Column:
        came, went, i = x["came"], x["went"], acc["at"] + 1
        n_went = F.when(went > 0, F.get(acc["counts"], went - 1)).otherwise(F.lit(0))
        n_came = F.get(acc["counts"], came - 1) - F.when(came == went, 1).otherwise(0)
        total = (
            acc["sum"]
            - F.get(term, n_went) + F.get(term, F.greatest(n_went - 1, F.lit(0)))
            + F.get(term, n_came + 1) - F.get(term, n_came)
        )
        counts = F.transform(
            acc["counts"],
            lambda c, k: c + F.when(k + 1 == came, 1).otherwise(0) - F.when(k + 1 == went, 1).otherwise(0),
        )
        hot = (i >= WINDOW) & (total <= acc["limit"])
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            acc["limit"].alias("limit"),
            i.alias("at"),
            F.when(hot & (acc["first"] == 0), i).otherwise(acc["first"]).alias("first"),
            F.when(hot, i).otherwise(acc["last"]).alias("last"),
        )

    return F.aggregate(
        steps, start, step, lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last"))
    )


def _limit(candidate: Column) -> Column:
    return (
        F.when(candidate.rlike("^[0-9a-fA-F]+$"), most_repetition(BITS["hex"]))
        .when(candidate.rlike("[A-Z]") & candidate.rlike("[a-z]"), most_repetition(BITS["mixed"]))
        .otherwise(most_repetition(BITS["single_case"]))
        .cast("bigint")
    )


def _slim(spans: Column) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["begin"].alias("begin"), s["kind"].alias("kind"), s["end"].alias("end"))
    )


def _events(spans: Column, of: int) -> Column:
    """Where the spans begin (1) and end (-1), as ``(at, step, of)``."""

    def event(place: str, step: int) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(s[place].alias("at"), F.lit(step).alias("step"), F.lit(of).alias("of")),
        )

    return F.concat(event("begin", 1), event("end", -1))


def _outside(extra: Column, base: Column) -> Column:
    """The parts of the spans ``extra`` that no span of ``base`` covers.

    Between two neighbouring ends of spans everything is covered alike, so the ends are sorted
    and the open spans of either kind counted along them.
    """
    none = F.array().cast("array<struct<begin:int,kind:int,end:int>>")

    def open_(events: Column, of: int) -> Column:
        return _running(F.transform(events, lambda e: F.when(e["of"] == of, e["step"]).otherwise(0)))

    def parts(events: Column) -> Column:
        def part(e: Column, i: Column) -> Column:
            return F.struct(
                e["at"].alias("begin"), F.lit(3).alias("kind"), F.get(events, i + 1)["at"].alias("end")
            )

        def free(wanted: Column, covered: Column) -> Column:
            counted = F.arrays_zip(
                F.transform(events, part).alias("p"), wanted.alias("wanted"), covered.alias("covered")
            )
            kept = F.filter(
                counted,
                lambda x: (x["wanted"] > 0) & (x["covered"] == 0) & (x["p"]["begin"] < x["p"]["end"]),
            )
            return F.transform(kept, lambda x: x["p"])

        return _let(open_(events, 1), lambda w: _let(open_(events, 0), lambda c: free(w, c)))

    events = F.array_sort(F.concat(_events(extra, 1), _events(base, 0)))
    return (
        F.when(F.size(extra) == 0, none).when(F.size(base) == 0, extra).otherwise(_let(events, parts))
    )


def find(df: DataFrame, text: str = "text", into: str = "secret_spans") -> DataFrame:
    """Append ``into``: all spans ``(begin, kind, end)`` by start, then kind.

    ``kind`` is the place in ``KINDS``. Of entropy spans the parts outside all base spans are given.
    Other columns stay, except one named ``into`` in any case.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != into.lower()]
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    group = lambda s: F.regexp_extract(s["match"], ASSIGN, 2)
    assign = F.filter(_spans(t, ASSIGN, 0), lambda s: F.char_length(group(s)) >= ASSIGN_LEAST)
    candidates = F.filter(
        _spans(t, CANDIDATE, 3),
        lambda s: ~s["match"].rlike(ALLOWED) & ~s["before"].rlike(ALLOWED_BEFORE),
    )
    # One step after another: each expensive array is computed once and then only read.
    row = df.select(
        F.struct(*kept).alias("row"),
        _slim(assign).alias("a"),
        _slim(_spans(t, ACCESS, 1)).alias("k"),
        _slim(_spans(t, HEX, 2)).alias("h"),
        candidates.alias("c"),
    )
    row = row.select(
        "row",
        F.concat("a", "k", "h").alias("base"),
        F.transform(
            "c",
            lambda s: F.struct(
                s["begin"].alias("begin"), _hot(s["match"], _limit(s["match"])).alias("hot")
            ),
        ).alias("c"),
    )
    extra = F.transform(
        F.filter("c", lambda s: s["hot"]["first"] > 0),
        lambda s: F.struct(
            (s["begin"] + s["hot"]["first"] - WINDOW).alias("begin"),
            F.lit(3).alias("kind"),
            (s["begin"] + s["hot"]["last"]).alias("end"),
        ),
    )
    row = row.select("row", "base", extra.alias("extra"))
    parts = _outside(F.col("extra"), F.col("base"))
    return row.select("row.*", F.array_sort(F.concat("base", parts)).alias(into))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["begin"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts by base kind, digest of the base spans, and all spans."""
    found = find(docs.select("doc_id", "text"), "text", "secret_spans").select("doc_id", "secret_spans")
    count = lambda k: F.size(F.filter("secret_spans", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_written(F.filter("secret_spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        _written(F.col("secret_spans")).alias("spans"),
    )


def _united(spans: Column) -> Column:
    """``(begin, end)`` of the union of ``spans``; spans that only touch stay apart."""

    def edges(events: Column, depths: Column) -> Column:
        zipped = F.zip_with(
            events, depths, lambda e, d: F.struct(e["at"].alias("at"), e["step"].alias("step"), d.alias("depth"))
        )
        opened = lambda z: F.filter(z, lambda x: (x["step"] == 1) & (x["depth"] == 1))
        closed = lambda z: F.filter(z, lambda x: x["depth"] == 0)
        pair = lambda o, c: F.struct(o["at"].alias("begin"), c["at"].alias("end"))
        return _let(zipped, lambda z: F.zip_with(opened(z), closed(z), pair))

    # At one place ends come before beginnings.
    steps = lambda events: _running(F.transform(events, lambda e: e["step"]))
    return _let(F.array_sort(_events(spans, 0)), lambda events: edges(events, steps(events)))


def _without(text: Column, spans: Column, with_: str) -> Column:
    """``text`` with ``with_`` for each of the disjoint, sorted ``spans``.

    A place in a text is found by reading up to it, so pieces are cut from parts of the text that
    hold ``RUN`` spans each.
    """

    def end_before(i: Column) -> Column:
        return F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))

    def cut(part: Column, k: Column) -> Column:
        origin = end_before(k * RUN)

        def piece(s: Column, i: Column) -> Column:
            begin = end_before(k * RUN + i)
            return F.concat(F.substring(part, begin - origin + 1, s["begin"] - begin), F.lit(with_))

        return F.array_join(F.transform(F.slice(spans, k * RUN + 1, F.lit(RUN)), piece), "")

    def part(k: Column) -> Column:
        origin = end_before(k * RUN)
        last = end_before(F.least((k + 1) * RUN, F.size(spans)))
        return _let(F.substring(text, origin + 1, last - origin), lambda p: cut(p, k))

    at = F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / RUN).cast("int"))
    rest = F.substring(text, end_before(F.size(spans)) + 1, F.char_length(text))
    return F.concat(F.array_join(F.transform(at, part), ""), rest)


def redact(df: DataFrame, text: str = "text", with_: str = REDACTED) -> DataFrame:
    """``df`` with every span in ``text`` replaced by ``with_``; overlapping spans become one."""
    found = find(df, text, "__spans")
    t = F.col(f"`{text}`")
    without = _let(_united(F.col("__spans")), lambda spans: _without(t, spans, with_))
    cut = F.when(F.size("__spans") > 0, without).otherwise(t)
    return found.select(*[cut.alias(c) if c == text else F.col(f"`{c}`") for c in df.columns])
