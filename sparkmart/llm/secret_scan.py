"""Secret scans: known patterns, and high-entropy parts of candidate strings.

Method: over every candidate string (a long run of token characters with a digit) slides a
window; its Shannon entropy follows from counts that change by one character in and one
out per step. A threshold per character class tells keys from words; what is on the
allow-list is suppressed. ``by_part`` decides whether class and allow-list apply to each window
and to the part that matches, or to a candidate as a whole, which hides keys behind key= and
beside placeholders. All of it is expressions on the row: no shuffle and no Python.

Positions are code points, ends exclusive.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of the report, with their patterns.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}+"  # a run of 24 or more is all that is left of [0-9a-f]+
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
#: Bits per character from which a window is suspicious; 4.32 is the most 20 characters have.
THRESHOLDS = {"hex": 3.0, "other": 3.7, "letters": 3.7}
#: Candidates that are no secrets: UUIDs, placeholders, one character over and over, counting.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)example|placeholder|changeme|dummy|x{6}",
    r"^(.)\1*$",
    r"(?i)0123456789|abcdefghij",
    r"^[0-9]+([-/_][0-9]+)*$",
)
#: The same by part: any long run is a candidate, and what is allowed is cut out of it.
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
ALLOWED_PARTS = (
    r"(?<![A-Za-z0-9])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![A-Za-z0-9])"
    r"|(?i:example|placeholder|changeme|dummy|x{6,}|0123456789|abcdefghij)"
    r"|(?<![A-Za-z0-9])(?=[0-9/_-]{20})[0-9]+(?:[-/_][0-9]+)*+(?![A-Za-z0-9])"
)
PART = rf"(?:{ALLOWED_PARTS})|\G((?:(?!{ALLOWED_PARTS})[A-Za-z0-9+/_=-]){{20,}}+)"


def _spans(text: Column, pattern: str, group: int = 0) -> Column:
    """Start, end, match and one group of all matches: the gaps between them give the places."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), whole.alias("found"), parts.alias("part")
    )
    start = F.struct(
        F.lit(0).alias("at"),
        F.expr("cast(array() as array<struct<start:int,end:int,found:string,part:string>>)").alias(
            "spans"
        ),
    )

    def step(state: Column, x: Column) -> Column:
        low = state["at"] + F.length(x["gap"])
        high = low + F.coalesce(F.length(x["found"]), F.lit(0))
        span = F.struct(
            low.alias("start"), high.alias("end"), x["found"].alias("found"), x["part"].alias("part")
        )
        return F.struct(
            high.alias("at"),
            F.when(x["found"].isNull(), state["spans"])
            .otherwise(F.concat(state["spans"], F.array(span)))
            .alias("spans"),
        )

    none = F.expr("cast(array() as array<struct<start:int,end:int,found:string,part:string>>)")
    return F.when(
        text.rlike(pattern), F.aggregate(zipped, start, step, lambda state: state["spans"])
    ).otherwise(none)


def _entropy_range(
    found: Column, window: int, thresholds: dict[str, float], by_part: bool = False
) -> Column:
    """First and last window (by last character, 0-based) above the threshold, -1 for none."""
    weights = F.array(*[F.lit(c * log2(c) if c > 1 else 0.0) for c in range(window + 2)])

    def weight(count: Column) -> Column:
        return F.get(weights, count)

    codes = F.transform(F.split(found, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    hexadecimal = F.array(*[F.lit(int(c in "0123456789abcdefABCDEF")) for c in ALPHABET])

    def most(threshold: str) -> Column:  # of the sum of count * log2(count)
        least = thresholds.get(threshold, thresholds["other"])
        return F.lit((log2(window) - least) * window)

    def limit(n_hex: Column) -> Column:
        if not by_part:
            return F.when(found.rlike("^[0-9a-fA-F]+$"), most("hex")).otherwise(most("other"))
        return (
            F.when(~found.rlike("[0-9]"), most("letters"))
            .when(n_hex == window, most("hex"))
            .otherwise(most("other"))
        )

    zeros = F.array_repeat(F.lit(0), len(ALPHABET))
    # each step has the character that comes in, the one that goes out, and its place
    out = F.concat(F.array_repeat(F.lit(-1), window), codes)
    steps = F.arrays_zip(codes.alias("enters"), out.alias("leaves"))
    steps = F.slice(steps, 1, F.length(found))
    start = F.struct(
        zeros.alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(0).alias("n_hex"),
        F.lit(0).alias("at"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
    )

    def step(state: Column, x: Column) -> Column:
        enters, leaves, counts = x["enters"], x["leaves"], state["counts"]
        more, less = F.get(counts, enters), F.get(counts, leaves)
        change = weight(more + 1) - weight(more)
        change = change + F.when(leaves >= 0, weight(less - 1) - weight(less)).otherwise(0.0)
        total = state["sum"] + F.when(enters == leaves, 0.0).otherwise(change)
        n_hex = state["n_hex"] + F.get(hexadecimal, enters)
        n_hex = n_hex - F.when(leaves >= 0, F.get(hexadecimal, leaves)).otherwise(0)
        hit = (state["at"] >= window - 1) & (total <= limit(n_hex))
        return F.struct(
            F.when(enters == leaves, counts)
            .otherwise(
                F.transform(
                    counts,
                    lambda c, i: c
                    + F.when(i == enters, 1).otherwise(0)
                    - F.when(i == leaves, 1).otherwise(0),
                )
            )
            .alias("counts"),
            total.alias("sum"),
            n_hex.alias("n_hex"),
            (state["at"] + 1).alias("at"),
            F.when(hit & (state["first"] < 0), state["at"]).otherwise(state["first"]).alias("first"),
            F.when(hit, state["at"]).otherwise(state["last"]).alias("last"),
        )

    return F.aggregate(
        steps, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))
    )


def _named(spans: Column, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")
        ),
    )


def scan(
    docs: DataFrame,
    window: int = WINDOW,
    thresholds: dict[str, float] | None = None,
    by_part: bool = False,
) -> DataFrame:
    """``docs`` with ``secrets``: all spans (start, kind, end) by start and kind.

    ``kind`` is an index of ``KINDS``. An entropy span reaches from the first to the last
    window of a candidate (``by_part``: of what the allow-list leaves of it in one piece) that
    is above the threshold. ``by_part`` each window has its own class, and candidates without
    a digit are scored too. A null text counts as empty, which
    has no secrets; all rows and columns are kept, and a column ``secrets`` is replaced.
    """
    thresholds = thresholds or THRESHOLDS
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(_spans(text, ASSIGN, 2), lambda s: F.length(s["part"]) >= 6)
    access = F.filter(_spans(text, ACCESS), lambda s: F.length(s["found"]) >= 20)
    allowed = "|".join(f"(?:{p})" for p in ALLOWED[:2] + ALLOWED[3:])

    def judged(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"),
            _entropy_range(s["found"], window, thresholds, by_part).alias("hit"),
        )

    def pieces(s: Column) -> Column:
        parts = F.filter(_spans(s["found"], PART, 1), lambda p: F.length(p["part"]) > 0)
        return F.transform(
            parts,
            lambda p: F.struct(
                (s["start"] + p["start"]).alias("start"), p["part"].alias("found")
            ),
        )

    if by_part:
        candidates = F.flatten(F.transform(_spans(text, RUN), pieces))
    else:
        candidates = F.filter(
            _spans(text, CANDIDATE),
            lambda s: ~s["found"].rlike(allowed) & ~s["found"].rlike(ALLOWED[2]),
        )
    entropy = F.transform(
        F.filter(F.transform(candidates, judged), lambda s: s["hit"]["first"] >= 0),
        lambda s: F.struct(
            (s["start"] + s["hit"]["first"] - (window - 1)).alias("start"),
            F.lit(KINDS.index("entropy")).alias("kind"),
            (s["start"] + s["hit"]["last"] + 1).alias("end"),
        ),
    )
    return docs.withColumn(
        "secrets",
        F.array_sort(
            F.concat(
                _named(assign, "assign"),
                _named(access, "access"),
                _named(_spans(text, HEX), "hex"),
                entropy,
            )
        ),
    )


def labels(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(scanned: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The scanned rows with every secret in ``text`` replaced by ``mark``.

    Spans that overlap or touch are one. Texts without secrets, null ones too, stay as they are.
    """
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        gap = text.substr(state["at"] + 1, s["start"] - state["at"])
        fresh = (s["start"] > state["at"]) | (F.size(state["parts"]) == 0)
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(state["parts"], F.array(gap, F.lit(mark))))
            .otherwise(state["parts"])
            .alias("parts"),
        )

    done = F.aggregate(
        "secrets",
        start,
        step,
        lambda s: F.concat(
            F.array_join(s["parts"], ""), text.substr(s["at"] + 1, F.length(text))
        ),
    )
    return scanned.withColumn("text", F.when(F.size("secrets") > 0, done).otherwise(text))
