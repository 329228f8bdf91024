"""Mixing of sources: proportional fitting of token weights, then calibrated sampling (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, stored, words_sql

#: Stands for a null category.
NONE = "(none)"

#: Production parameters: a marginal's target share is its share of tokens to this power, and
#: ``KEEP`` of all tokens is aimed at.
TEMPER, KEEP, SWEEPS = 0.7, 0.6, 12


def topic_sql(text: str = "text") -> str:
    """SQL for the rough topic of a text, by the first rule that fits."""
    return f"""case when {text} is null or {text} = '' then '{NONE}' when {text} like '% | %' then 'table'
        when lower({text}) like '%licens%' then 'legal' when {text} like '%@%' then 'contact'
        when {text} like '%\n%' then 'sections' else 'paragraph' end"""


#: Cells that one task fits; more are fitted by shuffles.
_CELLS = 200_000


def _cell() -> Column:
    named = [F.coalesce(F.col(c), F.lit(NONE)).alias(c) for c in ("source", "lang")]
    return F.struct(*named, F.expr(topic_sql()).alias("topic"))


def _n_tokens() -> Column:
    return F.greatest(F.lit(1), F.expr(f"size({words_sql()})")).cast("bigint")


def _draw(seed: int) -> Column:
    """A number in [0, 1) that depends on doc_id and seed alone, on any engine with MD5."""
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit(NONE)), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def reachable(cells: DataFrame, name: str, share: DataFrame, budget: float, capped: bool = True) -> DataFrame:
    """(category, share, target) of one marginal: the tokens that each category is to get of ``budget``.

    Shares of categories that ``cells`` (tokens) has are brought to 1; those without one get none. If
    ``capped``, a category with fewer tokens than its part gives all it has, and the others share what it
    lacks in proportion, until all is dealt or nothing is left.
    """
    own = cells.groupBy(name).agg(F.sum("tokens").alias("cap")).join(share.select(name, F.col("share").cast("double").alias("s")), name, "left").fillna(0.0, ["s"])
    own = own.withColumn("s", F.expr("s / sum(s) over ()"))
    if not capped:
        return own.select(name, F.coalesce("s", F.lit(0.0)).alias("share"), F.coalesce(F.col("s") * budget, F.lit(0.0)).alias("target"))
    # From the scarcest on: what is left of the budget over what is left of the shares.
    some = own.where("s > 0").withColumn("ratio", F.col("cap") / F.col("s"))
    before = f"coalesce(sum(cap) over (order by ratio, `{name}` rows between unbounded preceding and 1 preceding), 0)"
    after = f"sum(s) over (order by ratio, `{name}` rows between current row and unbounded following)"
    level = some.withColumn("level", F.expr(f"({budget!r}D - {before}) / {after}"))
    level = level.withColumn("dealt", F.expr("max(if(ratio > level, level, null)) over ()"))
    target = F.when(F.col("ratio") <= F.col("level"), F.col("cap").cast("double")).otherwise(F.col("s") * F.col("dealt"))
    return own.select(name, F.coalesce("s", F.lit(0.0)).alias("share")).join(level.select(name, target.alias("target")), name, "left").fillna(0.0, ["target"])


def rake(cells: DataFrame, targets: dict[str, DataFrame], keep: float, sweeps: int = SWEEPS, capped: bool = True) -> DataFrame:
    """``cells`` (categories and ``tokens``) with ``fitted`` tokens, of ``keep`` of all, and the ``t_`` targets of their categories.

    Each target table has a category and its ``share``. A sweep scales the cells to each marginal's
    reachable target in turn; if ``capped``, none to more than it has, so that the next scalings give
    to the others what it lacks. Cells number the product of the categories at most, whatever the
    number of documents; up to ``_CELLS`` are fitted in one task without a shuffle.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    fitted = cells.withColumn("fitted", F.col("tokens").cast("double"))
    for name, share in targets.items():
        fitted = fitted.join(reachable(cells, name, share, total * keep, capped).select(name, F.col("target").alias(f"t_{name}")), name)
    fitted = stored(fitted, "cells")
    one = fitted.count() <= _CELLS
    for sweep in range(sweeps):
        fitted = fitted.coalesce(1) if one else fitted
        for name in targets:
            held = F.expr(f"sum(fitted) over (partition by `{name}`)")
            scale = F.when(held > 0, F.col("fitted") * F.col(f"t_{name}") / held).otherwise(0.0)
            fitted = fitted.withColumn("fitted", F.least(scale, F.col("tokens").cast("double")) if capped else scale)
        if sweep % 4 == 3:
            fitted = stored(fitted, "cells")
    return fitted


def balance(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, power: float = TEMPER, sweeps: int = SWEEPS, repeats: bool = False) -> DataFrame:
    """What the mixture reaches: marginal, value, tokens, target, expected and residual (target less expected).

    A residual that is not near 0 says that the marginals contradict each other: no draw has them all.
    """
    names = ("source", "lang", "topic")
    cells = _cells(_counted(docs))
    fitted = stored(rake(cells, targets or tempered(cells, names, power), keep, sweeps, not repeats), "balance")
    out = None
    for n in names:
        sums = fitted.groupBy(F.lit(n).alias("marginal"), F.col(n).alias("value")).agg(F.sum("tokens").alias("tokens"), F.max(f"t_{n}").alias("target"), F.sum("fitted").alias("expected"))
        out = sums if out is None else out.unionByName(sums)
    return out.withColumn("residual", F.col("target") - F.col("expected"))


def tempered(cells: DataFrame, names: tuple[str, ...], power: float) -> dict[str, DataFrame]:
    """Targets that lie between the corpus's own shares (power 1) and equal ones (power 0)."""
    out = {}
    for name in names:
        own = cells.groupBy(name).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("p"))
        out[name] = own.select(name, (F.col("p") / F.expr("sum(p) over ()")).alias("share"))
    return out


def _counted(docs: DataFrame) -> DataFrame:
    """doc_id, cell and n_tokens of each document, as files: texts are split once."""
    return stored(docs.select("doc_id", _cell().alias("cell"), _n_tokens().alias("n_tokens")), "counted")


def _cells(counted: DataFrame) -> DataFrame:
    return stored(counted.groupBy("cell").agg(F.sum("n_tokens").alias("tokens")).select("cell.*", "tokens"), "cells")


def _chances(each: DataFrame, counted: DataFrame, targets: dict[str, DataFrame] | None, keep: float, power: float, sweeps: int, seed: int, repeats: bool) -> DataFrame:
    """``each`` (doc_id and ``__cell``) with ``__chance``: weight, p, selected, expected and times."""
    names = ("source", "lang", "topic")
    cells = _cells(counted)
    fitted = rake(cells, targets or tempered(cells, names, power), keep, sweeps, not repeats)
    total = F.expr("sum(fitted) over ()")
    weight = F.round(F.when(total > 0, F.col("fitted") / total).otherwise(0.0), 9)
    chances = fitted.select(F.struct(*names).alias("__cell"), weight.alias("__weight"), F.round(F.col("fitted") / F.col("tokens"), 9).alias("__e"))
    # Cells are the product of the categories, whatever the number of documents; should they be
    # many all the same, the join is by a shuffle.
    drawn = each.join(small(stored(chances, "chances"), _CELLS), "__cell")
    p, whole = F.least(F.lit(1.0), F.col("__e")), F.floor("__e")
    times = whole + (_draw(seed) < F.col("__e") - whole).cast("bigint")
    chance = F.struct(F.col("__weight").alias("weight"), p.alias("p"), (_draw(seed) < p).alias("selected"), F.col("__e").alias("expected"), times.alias("times"))
    return drawn.withColumn("__chance", chance).drop("__weight", "__e")


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, power: float = TEMPER, sweeps: int = SWEEPS, seed: int = 0, repeats: bool = False) -> DataFrame:
    """Each document's chance under the mixture, and whether it is drawn.

    Returns doc_id, source, lang, topic, n_tokens, weight (its cell's fitted share of tokens), p (the
    cell's fitted tokens over its own, at most 1) and selected. ``keep`` of all tokens is aimed at;
    what a category has too few tokens for is dealt to the others of its marginal (``reachable``), and
    what a cell has too few for to the other cells (``rake``); ``balance`` gives what is reached. With ``repeats``
    the targets hold as they are: two more columns give the expected count (p without its limit of 1) and
    ``times``, how often the document is drawn, at least once where selected. Null categories count
    as ``(none)``, a null or empty text as one token. Equal doc_ids are drawn alike, null ones as one
    id. An empty table gives none.
    """
    names = ("weight", "p", "selected") + (("expected", "times") if repeats else ())
    counted = _counted(docs)
    drawn = _chances(counted.withColumnRenamed("cell", "__cell"), counted, targets, keep, power, sweeps, seed, repeats)
    return drawn.select("doc_id", "__cell.*", "n_tokens", *[f"__chance.{n}" for n in names])


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, power: float = TEMPER, sweeps: int = SWEEPS, seed: int = 0, repeats: bool = False) -> DataFrame:
    """The documents drawn, with their own columns, as ``mix`` draws them; with ``repeats`` a row for each time."""
    own = {c: f"__own_{i}" for i, c in enumerate(docs.columns)}  # so that no name of theirs meets one of ours
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()], "doc_id", _cell().alias("__cell"))
    drawn = _chances(inner, _counted(docs), targets, keep, power, sweeps, seed, repeats).where("__chance.selected")
    if repeats:
        drawn = drawn.withColumn("__time", F.explode(F.expr("sequence(1L, __chance.times)")))
    return drawn.select(*[F.col(n).alias(c) for c, n in own.items()])
