"""Secret scans over a ledger of content-addressed blobs (DataFrame functions only)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, scratch, shared_dir, small, spare, stored


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its Java pattern, and how many code points ``group`` needs at least."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1
    base: bool = False

    @property
    def pair(self) -> str:
        return f"{self.kind}@{self.version}"


#: Ranked as listed. The first three are the base; ``{12,}`` and ``{32,}`` find just the runs that
#: the open-ended patterns find and that are long enough.
RULES = (
    Rule("assign", r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8, base=True),
    Rule("access", r"AKIA[A-Z0-9]{12,}", base=True),
    Rule("hex", r"[0-9a-f]{32,}", base=True),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("login_url", r"[a-z][a-z0-9+]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@"),
)

#: Blobs that may be named to all tasks.
_NAMED = 1_000_000

_SPANS = "array<struct<start: bigint, rank: int, kind: string, stop: bigint>>"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans_sql(rule: Rule, rank: int, text: str = "text") -> str:
    """SQL for a rule's spans: leftmost matches that don't overlap, then those too short dropped.

    ``split`` gives what lies between the matches, and the sum of all lengths before places a match.
    The sums are taken over blocks of matches first, so n matches cost about n to the power 1.5.
    """
    p = _literal(rule.pattern)
    total = "aggregate({0}, 0L, (a, b) -> a + b)"
    before = f"p[j div b] + {total.format('slice(l, cast(j div b as int) * b + 1, j % b)')} + length(g[j])"
    places = f"""filter(transform(m, (x, j) -> named_struct('start', {before},
        'rank', {rank}, 'kind', '{rule.kind}', 'stop', cast(length(x) as bigint), 'own', length(v[j]))), x -> x.own >= {rule.least})"""
    moved = f"transform({places}, x -> named_struct('start', x.start, 'rank', x.rank, 'kind', x.kind, 'stop', x.start + x.stop))"
    blocks = "sequence(0, cast((size(m) - 1) div b as int))"
    sums = f"transform({blocks}, k -> {total.format('slice(l, k * b + 1, b)')})"
    firsts = f"transform({blocks}, k -> {total.format('slice(s, 1, k)')})"
    placed = let("l", "transform(m, (x, j) -> cast(length(x) + length(g[j]) as bigint))", let("b", "cast(ceil(sqrt(size(m))) as int)", let("s", sums, let("p", firsts, moved))))
    own = f"regexp_extract_all({text}, {p}, {rule.group})"
    found = let("m", f"regexp_extract_all({text}, {p}, 0)", let("v", own, let("g", f"split({text}, {p}, -1)", placed)))
    return f"if({text} rlike {p}, {found}, cast(array() as {_SPANS}))"


def scan(versions: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """Adds to the ledger what no earlier scan has seen of ``versions`` (text): (the whole ledger, its path).

    ``versions`` may have a row for each path and version of it. A blob is the SHA-256 of a text; null
    counts as empty. A ledger row says which rule versions were run over a blob and what they found. A
    blob is scanned once however many paths hold it, only with the rule versions that its rows lack.
    Texts are scanned where they are read; only those that occur twice or more are shuffled, after the
    copies of a task have met, and if there are too many of them to be named to all tasks, all that are to be scanned. Each
    scan writes its rows as files of their own, so a failed one leaves none.
    """
    spark = versions.sparkSession
    shared_dir(spark)
    texts = versions.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("blob_id", F.sha2("text", 256))
    counted = stored(texts.groupBy("blob_id").agg(F.count("*").alias("n")), "blobs")
    every = F.array(*[F.lit(r.pair) for r in rules])
    if ledger is None:
        ledger = scratch(spark, "ledger")
        # 64 bits will do: a blob that shares its own with a copied one is just grouped with the copies.
        mark = F.xxhash64("blob_id").alias("mark")
        again = small(counted.where("n > 1").select(mark), _NAMED)
        marked = texts.withColumn("mark", mark)
        single, copied = (marked.join(again, "mark", how).drop("mark") for how in ("left_anti", "left_semi"))
        todo = single.union(copied.groupBy("blob_id").agg(F.first("text").alias("text")).select(*single.columns)).withColumn("todo", every)
    else:
        seen = spark.read.parquet(ledger).select("blob_id", F.explode("pairs").alias("pair")).groupBy("blob_id").agg(F.collect_set("pair").alias("seen"))
        missing = F.array_except(every, F.coalesce("seen", F.expr("cast(array() as array<string>)")))
        unseen = stored(counted.join(seen, "blob_id", "left").select("blob_id", "n", missing.alias("todo")).where(F.size("todo") > 0), "unseen")
        single = texts.join(small(unseen.where("n = 1").drop("n"), _NAMED), "blob_id")
        copied = texts.join(small(unseen.where("n > 1").drop("n"), _NAMED), "blob_id")
        todo = single.union(copied.groupBy("blob_id", "todo").agg(F.first("text").alias("text")).select(*single.columns))
    parts = [F.expr(f"if(array_contains(todo, '{r.pair}'), {spans_sql(r, k)}, cast(array() as {_SPANS}))") for k, r in enumerate(rules)]
    found = todo.select("blob_id", F.col("todo").alias("pairs"), F.array_sort(F.concat(*parts)).alias("found"))
    found.write.mode("append").parquet(ledger)
    return spark.read.schema(found.schema).parquet(ledger), ledger


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of ``paths`` (doc_id, text) with its blob's findings under ``rules``.

    Adds blob_id and found, an array of (start, rank, kind, stop) by start and rank. A null or empty
    text, or one without findings, gets an empty array. Repeated rows each get their findings. Columns of ``paths`` that
    have these names stay as they are, and those that are added have underscores before them.
    """
    pairs = [r.pair for r in rules]
    kinds = [r.kind for r in rules]
    some = ledger.where(F.size("found") > 0).where(F.arrays_overlap("pairs", F.array(*[F.lit(p) for p in pairs])))
    run = {r.kind: r.pair for r in rules}
    wanted: Column = reduce(lambda a, b: a | b, [F.lit(False)])
    one = some.select("blob_id", "pairs", F.explode("found").alias("f"))
    wanted = reduce(lambda a, k: a | ((F.col("f.kind") == k) & F.array_contains("pairs", run[k])), kinds, wanted)
    # A blob's findings are at most its spans. Written, they come to the join by a shuffle of their
    # own, so that a blob which very many paths hold can be split.
    merged = stored(one.where(wanted).select("blob_id", "f").distinct().groupBy("blob_id").agg(F.array_sort(F.collect_list("f")).alias("found")), "found")
    blob, name, other = spare(paths, "blob_id"), spare(paths, "found"), spare(paths, "__blob")
    addressed = paths.withColumn(blob, F.sha2(F.coalesce("text", F.lit("")), 256)).drop("text")
    joined = addressed.join(merged.select(F.col("blob_id").alias(other), F.col("found").alias(f"{other}_found")), F.col(blob) == F.col(other), "left")
    spans = F.coalesce(F.col(f"{other}_found"), F.expr(f"cast(array() as {_SPANS})"))
    return joined.withColumn(name, spans).drop(other, f"{other}_found")


def report(found: DataFrame) -> DataFrame:
    """The digest columns of ``findings``: counts, a hash of the base spans, and all spans, from the last column, which it added."""
    found = found.select("doc_id", F.col(f"`{found.columns[-1]}`").alias("found"))
    base = [r.kind for r in RULES if r.base]

    def written(which: str) -> Column:
        return F.expr(f"array_join(transform({which}, x -> concat_ws(':', x.kind, x.start, x.stop)), ',')")

    counts = [F.expr(f"cast(size(filter(found, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in base]
    own = "filter(found, x -> x.kind in (" + ", ".join(f"'{k}'" for k in base) + "))"
    return found.select("doc_id", *counts, F.sha2(written(own), 256).alias("base_sha256"), written("found").alias("spans"))
