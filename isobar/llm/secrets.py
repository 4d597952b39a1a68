"""Secret scan with DataFrame functions only: fixed patterns, and sliding-window entropy.

The patterns (assign, access, hex) give the base spans. Besides them, every long run of key
characters is a candidate; where base spans touch a run, the parts of it outside them are. A window of
``WINDOW`` signs slides over a candidate; the counts of the signs in it are kept up by one sign entering
and one leaving, and with them the sum of c * log2(c), from which Shannon's entropy follows. The work
grows with the length of the candidate. Each character class has its own bound on the highest window
entropy (hexadecimal runs have fewer signs than mixed ones).

The allow list judges a candidate as a whole: it is cut at its separators and between camel case words,
and suppressed if every part is a plain word with at most four digits behind it, a short number or a
placeholder, and parts have three signs or more on average; numbers with separators are suppressed too.
One part that is none of these keeps the candidate. What remains is added as kind ``entropy``.

A null or empty text has no spans; offsets are code points, ends exclusive. Rows with equal ids
or texts get equal answers. Very long texts and runs are whole. Other columns are ignored.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the same as AKIA[A-Z0-9]+ of 20 or more signs
HEX = r"[0-9a-f]{24,}"  # the same as [0-9a-f]+ of 24 or more signs

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# (class, pattern, least entropy of a window); the first class that fits counts.
CLASSES = (("hex", "^[0-9A-Fa-f]+$", 3.0), ("upper", "^[A-Z0-9]+$", 3.4), ("lower", "^[a-z0-9]+$", 3.4), ("mixed", "", 3.7))
# Where a candidate is cut into parts, and what a harmless part looks like. No repeated groups: they would
# recurse on long runs.
SEPARATOR = r"[+/_=-]+|(?<=[a-z])(?=[A-Z])"
PLAIN = r"^([A-Z]?[a-z]*|[A-Z]+)[0-9]{0,4}$|^([xX]+|0+)$|(?i)^(0?123456789?0?|1234567|12345678)$"
NUMBERS = r"^[0-9+/_=-]+$"
PART = 3  # signs of a part, separators included, on average
SIGNS = 128


def located(text: str, pattern: str, kind: int, least: int = 0, group: int = 0) -> Column:
    """array<struct<start, kind, end>> of the matches whose ``group`` has ``least`` signs or more."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    sized = F.arrays_zip(
        F.transform(F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))), lambda g: F.length(g)).alias("gap"),
        F.transform(hits, lambda h: F.length(h)).alias("size"),
        F.transform(values, lambda v: F.length(v)).alias("value"),
    )
    span = lambda a, b: F.struct(a.alias("start"), F.lit(kind).alias("kind"), b.alias("end"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(acc: Column, m: Column) -> Column:
        a = acc["at"] + m["gap"]
        b = a + m["size"]
        more = F.when(m["value"] >= least, F.concat(acc["found"], F.array(span(a, b)))).otherwise(acc["found"])
        return F.struct(b.alias("at"), more.alias("found"))

    # Most texts have no match; they skip the splitting.
    return F.when(F.col(text).rlike(pattern), F.aggregate(sized, start, step, lambda acc: acc["found"])).otherwise(none)


def window_entropy(run: Column, window: int = WINDOW) -> Column:
    """Highest entropy of ``window`` consecutive signs of an ASCII string, by incremental counts."""
    terms = F.array(*[F.lit(c * log2(c) if c else 0.0) for c in range(window + 2)])
    term = lambda count: F.get(terms, count)
    # Each sign beside the one that leaves the window when it enters; the run is cut up once.
    codes = F.transform(F.slice(F.split(run, ""), F.lit(1), F.length(run)), lambda c: F.ascii(c))
    leaving = F.slice(F.concat(F.array_repeat(F.lit(-1), window), codes), F.lit(1), F.length(run))
    zero = F.struct(
        F.array_repeat(F.lit(0), SIGNS).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), F.lit(0).alias("seen")
    )

    def step(acc: Column, m: Column) -> Column:
        enters, leaves, full = m["enters"], m["leaves"], m["leaves"] >= 0
        had = F.get(acc["counts"], enters)
        grown = acc["sum"] + term(had + 1) - term(had)
        left = F.get(acc["counts"], leaves) + F.when(leaves == enters, 1).otherwise(0)
        total = F.when(full, grown + term(left - 1) - term(left)).otherwise(grown)
        counts = F.transform(
            acc["counts"],
            lambda c, k: c + F.when(k == enters, 1).otherwise(0) - F.when(k == leaves, 1).otherwise(0),
        )
        entropy = F.lit(log2(window)) - total / window
        best = F.when(acc["seen"] >= window - 1, F.greatest(acc["best"], entropy)).otherwise(acc["best"])
        return F.struct(counts.alias("counts"), total.alias("sum"), best.alias("best"), (acc["seen"] + 1).alias("seen"))

    return F.aggregate(F.arrays_zip(codes.alias("enters"), leaving.alias("leaves")), zero, step, lambda acc: acc["best"])


def allowed(run: Column) -> Column:
    """Whether all of a candidate is words, numbers and placeholders."""
    parts = F.split(run, SEPARATOR, -1)
    plain = F.forall(parts, lambda p: p.rlike(PLAIN))
    return run.rlike(NUMBERS) | (plain & (F.length(run) >= PART * F.size(parts)))


def candidates(text: str, base: str) -> Column:
    """array<struct<start, end, run>>: runs of key characters, or what base spans leave of them, long enough for a window."""
    gaps = F.split(text, CANDIDATE, -1)
    hits = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,run:string>>")
    sized = F.arrays_zip(
        F.transform(F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))), lambda g: F.length(g)).alias("gap"), hits.alias("run")
    )
    begin = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(acc: Column, m: Column) -> Column:
        a = acc["at"] + m["gap"]
        b = a + F.length(m["run"])
        one = F.array(F.struct(a.alias("start"), b.alias("end"), m["run"].alias("run")))
        return F.struct(b.alias("at"), F.concat(acc["found"], one).alias("found"))

    runs = F.aggregate(sized, begin, step, lambda acc: acc["found"])

    def rest(s: Column) -> Column:
        touching = F.filter(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        # Base spans ascend by start; each closes the part before it and opens the next behind it.
        opened = F.struct(s["start"].alias("at"), none.alias("found"))

        def close(acc: Column, b: Column) -> Column:
            part = F.struct(acc["at"].alias("start"), b["start"].alias("end"), F.lit("").alias("run"))
            more = F.when(b["start"] > acc["at"], F.concat(acc["found"], F.array(part))).otherwise(acc["found"])
            return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), more.alias("found"))

        def end(acc: Column) -> Column:
            part = F.struct(acc["at"].alias("start"), s["end"].alias("end"), F.lit("").alias("run"))
            return F.when(s["end"] > acc["at"], F.concat(acc["found"], F.array(part))).otherwise(acc["found"])

        def named(p: Column) -> Column:
            body = F.substring(s["run"], p["start"] - s["start"] + 1, p["end"] - p["start"])
            return F.struct(p["start"].alias("start"), p["end"].alias("end"), body.alias("run"))

        pieces = F.filter(F.aggregate(touching, opened, close, end), lambda p: p["end"] - p["start"] >= WINDOW)
        return F.when(F.size(touching) == 0, F.array(s)).otherwise(F.transform(pieces, named))

    return F.when(F.col(text).rlike(CANDIDATE), F.flatten(F.transform(runs, rest))).otherwise(none)


def least_entropy(run: Column) -> Column:
    bound = F.lit(CLASSES[-1][2])
    for _, pattern, least in reversed(CLASSES[:-1]):
        bound = F.when(run.rlike(pattern), F.lit(least)).otherwise(bound)
    return bound


def written(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def find(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, n_<kind> of base spans, base_sha256, spans) for every row."""
    rows = docs.select(id_column, F.coalesce(text, F.lit("")).alias("body"))
    rows = rows.withColumns({
        "assign": located("body", ASSIGN, 0, ASSIGN_LEAST, 2), "access": located("body", ACCESS, 1), "hex": located("body", HEX, 2),
    })
    rows = rows.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    rows = rows.withColumn("runs", F.filter(candidates("body", "base"), lambda s: ~allowed(s["run"])))
    rows = rows.withColumn("runs", F.filter("runs", lambda s: window_entropy(s["run"]) >= least_entropy(s["run"])))
    added = F.transform("runs", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS) - 1).alias("kind"), s["end"].alias("end")))
    rows = rows.withColumn("spans", F.array_sort(F.concat("base", added)))
    return rows.select(
        id_column, *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:-1]],
        F.sha2(written("base").cast("binary"), 256).alias("base_sha256"), written("spans").alias("spans"),
    )
