"""Secret scan: character Markov models of random strings and ordinary identifiers, by log-likelihood ratio.

Fixed patterns find assignments, access keys and long hex runs. Every other run of MIN_RUN or more characters out of
letters, digits and ``+/_=-`` is scored by two first-order character models, one of random strings and one of ordinary
identifiers: the log-likelihood ratio of its characters, less DRIFT for each, summed over the stretch where that is
largest. A run whose best stretch reaches the threshold is a secret too (kind ``markov``), also behind an ordinary path.

The samples are labelled by the patterns: values that a pattern found in the corpus are random, all other runs of the
corpus are ordinary. Samples by construction join them: strings derived from SEEDED hashes, and for the ordinary class long numbers
and the names in NAMED modules of the standard library, as they are and in paths. A
model is a mixture of fixed shares of its samples and of a uniform one, so a verdict does not depend on the size of the
corpus: ten copies of it give the same model.

Only built-in functions run on the text; there is no shuffle but for the few thousand character pair counts.

Defined cases: a null or empty text has no spans; repeated rows are scanned alike; places are code points, end
exclusive, and of the whole match; without any run to learn from, nothing is added to the patterns' spans;
an empty table gives no rows; all columns of the input stay, results replace columns of the same name.
"""

from __future__ import annotations

import math
from importlib import import_module

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns and lengths of the base kinds, in the order in which spans of one start are listed.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

MIN_RUN = 16
RUN = rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}"
KINDS = ["assign", "access", "hex", "markov"]
SEEDED = 2048
THRESHOLD = 12.0  # nats: a chance of about one in 160,000 for an ordinary stretch
DRIFT = 0.25  # nats a character
LETTERS = 67
# Shares of the samples in the models of a class, where a character occurs in them, and of the uniform model.
CORPUS_SHARE, SEEDED_SHARE = {True: 0.3, False: 0.5}, {True: 0.6, False: 0.4}
UNIFORM_SHARE = 0.1
NAMED = ["argparse", "asyncio", "builtins", "collections", "datetime", "inspect", "logging", "os", "pathlib", "subprocess", "threading",
         "typing", "unittest", "urllib.request"]
_BLOCK = 256
_FOUND = "array<struct<start:int,end:int,value:string>>"

# Running places of the matches: by blocks, so that the time is linear in their number.
_PLACED = f"""
flatten(transform(
  aggregate(transform(sequence(0, (size(_steps) - 1) div {_BLOCK}), b -> slice(_steps, int(b * {_BLOCK} + 1), {_BLOCK})),
    named_struct('at', 0, 'parts', cast(array() as array<struct<at:int,steps:array<struct<gap:int,size:int,value:string>>>>)),
    (a, b) -> named_struct('at', aggregate(b, a.at, (x, s) -> x + s.gap + s.size),
                           'parts', concat(a.parts, array(named_struct('at', a.at, 'steps', b)))),
    a -> a.parts),
  p -> aggregate(p.steps, named_struct('at', p.at, 'spans', cast(array() as {_FOUND})),
    (a, s) -> named_struct('at', a.at + s.gap + s.size, 'spans', concat(a.spans, array(named_struct(
      'start', a.at + s.gap, 'end', a.at + s.gap + s.size, 'value', s.value)))),
    a -> a.spans)))
"""


def _matches(df: DataFrame, text: Column, pattern: str, name: str) -> DataFrame:
    """``df`` with all leftmost non-overlapping matches of ``pattern``: the text between them gives their places."""
    df = df.withColumn("_found", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size("_found"))
    steps = F.zip_with("_found", gaps, lambda v, g: F.struct(
        F.length(g).alias("gap"), F.length(v).alias("size"), v.alias("value")))
    df = df.withColumn("_steps", F.when(F.size("_found") > 0, steps))
    empty = F.expr(f"cast(array() as {_FOUND})")
    return df.withColumn(name, F.when(F.col("_steps").isNull(), empty).otherwise(F.expr(_PLACED))).drop("_found", "_steps")


def _located(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the base spans (_assign, _access, _hex) and all runs that touch none of them (_runs)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    long_enough = lambda n: lambda s: F.length(s["value"]) >= n
    df = _matches(docs, whole, ASSIGN, "_assign")
    df = df.withColumn("_assign", F.filter(
        "_assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= MIN_ASSIGN))
    # A shorter whole run is dropped, so asking for the length in the pattern finds the same runs sooner.
    df = _matches(df, whole, ACCESS, "_access").withColumn("_access", F.filter("_access", long_enough(MIN_ACCESS)))
    df = _matches(df, whole, HEX.replace("+", f"{{{MIN_HEX},}}"), "_hex")
    df = _matches(df, whole, RUN, "_runs")
    base = F.concat("_assign", "_access", "_hex")
    touches = lambda r: F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
    return df.withColumn("_runs", F.filter("_runs", lambda r: ~touches(r)))


def _codes(value: Column) -> Column:
    return F.transform(F.split(value, ""), lambda c: F.ascii(c))


def _pair_counts(samples: DataFrame) -> DataFrame:
    """Rows (random, seeded, pair, n) of neighbouring characters of samples (random, seeded, value)."""
    codes = samples.select("random", "seeded", _codes(F.col("value")).alias("c")).where(F.size("c") > 1)
    pairs = F.zip_with(F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1),
                       lambda a, b: a * 128 + b)
    return codes.select("random", "seeded", F.explode(pairs).alias("pair")).where(
        "pair >= 0 and pair < 16384").groupBy("random", "seeded", "pair").agg(F.count("*").alias("n"))


def _names() -> list[str]:
    """Identifiers of the NAMED modules and paths made of them."""
    names = sorted({name.strip("_") for module in NAMED for name in dir(import_module(module))} - {""})
    return names + ["/".join(x.lower() for x in names[k::97][:6]) for k in range(97)]


def _seeded(spark) -> DataFrame:
    """Samples by construction: hashes of the numbers below SEEDED in base64 and hexadecimal digits, and as long numbers; names."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    number = F.conv(F.substring(digest, 25, 15), 16, 10)
    sample = lambda random, value: F.struct(F.lit(random).alias("random"), value.alias("value"))
    names = spark.range(1).select(F.explode(F.split(F.lit(" ".join(_names())), " ")).alias("value")).select(
        F.lit(False).alias("random"), "value")
    hashes = spark.range(SEEDED).select(F.inline(F.array(
        sample(True, F.substring(F.base64(F.unhex(digest)), 1, 40)), sample(True, F.substring(digest, 1, 16)),
        sample(True, F.upper(F.substring(digest, 17, 8))), sample(False, number))))
    return hashes.unionByName(names).withColumn("seeded", F.lit(True))


def _chances(counts: dict[tuple[bool, int], int], random: bool) -> list[float]:
    """Chance of each second character after the first (128 x 128) in the model of a class."""
    rows = {s: [sum(counts.get((s, a * 128 + b), 0) for b in range(128)) for a in range(128)] for s in (False, True)}
    shares = {False: CORPUS_SHARE[random], True: SEEDED_SHARE[random]}
    out = []
    for pair in range(16384):
        held = {s: shares[s] for s in shares if rows[s][pair // 128]}
        found = sum(share * counts.get((s, pair), 0) / rows[s][pair // 128] for s, share in held.items())
        uniform = UNIFORM_SHARE if held else 1.0
        out.append(found * (1 - uniform) / (sum(held.values()) or 1) + uniform / LETTERS)
    return out


def fit_secret_model(docs: DataFrame, text: str = "text") -> list[float]:
    """Log ratio of each pair of characters (128 x 128), from all runs of ``docs``.

    The driver gets at most one count per pair, class and source.
    """
    found = _located(docs.select(text), text)
    values = F.concat(
        F.transform("_assign", lambda s: F.struct(F.lit(True).alias("random"), F.regexp_extract(
            s["value"], ASSIGN, 2).alias("value"))),
        F.transform(F.concat("_access", "_hex"), lambda s: F.struct(F.lit(True).alias("random"), s["value"].alias("value"))),
        F.transform("_runs", lambda s: F.struct(F.lit(False).alias("random"), s["value"].alias("value"))))
    samples = found.select(F.inline(values)).withColumn("seeded", F.lit(False)).unionByName(_seeded(docs.sparkSession))
    counts: dict[bool, dict[tuple[bool, int], int]] = {True: {}, False: {}}
    for random, seeded, pair, n in _pair_counts(samples).collect():
        counts[random][seeded, pair] = n
    if not any(not seeded for seeded, _ in counts[False]):
        return [0.0] * 16384
    return [round(math.log(a / b), 9) for a, b in zip(_chances(counts[True], True), _chances(counts[False], False), strict=True)]


def _score(value: Column, model: list[float]) -> Column:
    """The largest sum of log ratios, less the drift, over a stretch of neighbouring characters."""
    weights = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    start = F.struct(F.lit(-1).alias("before"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))

    def step(a: Column, c: Column) -> Column:
        gain = F.when(a["before"] < 0, F.lit(0.0)).otherwise(F.get(weights, a["before"] * 128 + c) - DRIFT)
        total = F.greatest(a["total"] + gain, F.lit(0.0))
        return F.struct(c.alias("before"), total.alias("total"), F.greatest(a["best"], total).alias("best"))
    return F.aggregate(_codes(value), start, step, lambda a: a["best"])


def find_secrets(docs: DataFrame, model: list[float], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``secrets``: structs (start, rank, end, kind) in order of start, then of KINDS."""
    df = _located(docs.drop("secrets"), text)
    df = df.withColumn("_markov", F.filter("_runs", lambda r: _score(r["value"], model) >= threshold))
    of = lambda k, name: F.transform(f"_{name}", lambda s: F.struct(
        s["start"].alias("start"), F.lit(k).alias("rank"), s["end"].alias("end"), F.lit(name).alias("kind")))
    spans = F.array_sort(F.concat(*(of(k, name) for k, name in enumerate(KINDS))))
    return df.withColumn("secrets", spans).drop("_runs", *(f"_{name}" for name in KINDS))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` (with ``secrets``) whose text has every stretch of spans replaced by one ``mark``."""
    stretches = F.aggregate("secrets", F.expr("cast(array() as array<struct<start:int,end:int>>)"), lambda a, s: F.when(
        (F.size(a) > 0) & (F.get(a, F.size(a) - 1)["end"] >= s["start"]),
        F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
            F.get(a, F.size(a) - 1)["start"].alias("start"),
            F.greatest(F.get(a, F.size(a) - 1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    df = docs.withColumn("_cut", stretches)
    starts = F.concat(F.array(F.lit(0)), F.transform("_cut", lambda s: s["end"]))
    ends = F.concat(F.transform("_cut", lambda s: s["start"]), F.array(F.length(text)))
    parts = F.zip_with(starts, ends, lambda a, b: F.substring(F.col(text), a + 1, b - a))
    return df.withColumn(text, F.when(F.size("_cut") > 0, F.array_join(parts, mark)).otherwise(F.col(text))).drop("_cut")


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs, fit_secret_model(docs)).drop("text")
    base = F.filter("secrets", lambda s: s["kind"] != "markov")
    number = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(number(k).alias(f"n_{k}") for k in KINDS[:3]), F.sha2(listed(base), 256).alias(
        "base_sha256"), listed(F.col("secrets")).alias("spans"))
