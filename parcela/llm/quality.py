"""Quality rules: a threshold table compiled into one projection (no user functions, no shuffle)."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let, spare, words_sql

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a al als an and are as at au auch auf aux avec be but by como con dans das de del dem den der des die du "
    "ein eine el en es est et for from für had have he her his im in is ist it la las le les los man mit más n'est "
    "ne nicht no not of on one or ou para par pas plus por pour que qui se sich sie sind sont su sur that the their "
    "there they this to un una une und von war was we were which will with y you zu"
)


@dataclass(frozen=True)
class Rule:
    """Keep while ``numerator`` is at least ``low`` and at most ``high`` per cent of ``denominator``."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


#: The production table. Ratios are in per cent, so that whole numbers are compared.
RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 1500),
    Rule("symbols", "n_symbols", "n_words", None, 25),
    Rule("stop_words", "n_stop_words", "n_words", 3, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 45),
)
LEAST_WORDS, MOST_REPEATED = 50, 50

_POS = 20  # bits of a packed long that hold a word's place


def _repeats_sql() -> str:
    """SQL over ``w``, the words: how many lie in 3-word windows that occur twice or more.

    Windows are hashed; no two equal hashes means no repeat. Otherwise hash and place are packed
    into one long and sorted, neighbours of one hash prefix being compared word by word. Should
    two different windows share a prefix, or a text be too long for the packing, the windows
    themselves are sorted instead, so the count is always exact.
    """
    mask = (1 << _POS) - 1

    def covered(places: str) -> str:
        ends = "if(j + 1 < size(p), least(3L, p[j + 1] - p[j]), 3L)"
        return let("p", places, f"aggregate(transform(p, (x, j) -> {ends}), 0L, (a, b) -> a + b)")

    at = f"cast(x & {mask}L as int)"
    to = f"cast(s[j - 1] & {mask}L as int)"
    same = " and ".join(f"w[{at} + {k}] = w[{to} + {k}]" for k in range(3))
    # 0: another prefix, 1: the same window, 2: the same prefix only
    met = let(
        "e",
        f"transform(s, (x, j) -> case when j = 0 or shiftright(x ^ s[greatest(j - 1, 0)], {_POS}) <> 0 then 0 when {same} then 1 else 2 end)",
        f"if(array_contains(e, 2), cast(null as array<bigint>), sort_array(filter(transform(s, (x, j) -> if(e[j] = 1 or (j + 1 < size(e) and e[least(j + 1, size(e) - 1)] = 1), x & {mask}L, -1L)), x -> x >= 0)))",
    )
    fast = let("s", f"sort_array(transform(h, (x, j) -> (x & ~{mask}L) | cast(j as bigint)))", met)
    window = "named_struct('a', w[j], 'b', w[j + 1], 'c', w[j + 2], 'j', cast(j as bigint))"
    equal = "(s[{0}].a = x.a and s[{0}].b = x.b and s[{0}].c = x.c)"
    slow = let(
        "s",
        f"sort_array(transform(h, (x, j) -> {window}))",
        f"sort_array(transform(filter(s, (x, j) -> (j > 0 and {equal.format('greatest(j - 1, 0)')}) or (j + 1 < size(s) and {equal.format('least(j + 1, size(s) - 1)')})), x -> x.j))",
    )
    places = let("f", f"if(size(h) > {mask}, cast(null as array<bigint>), {fast})", f"if(f is null, {slow}, f)")
    h = "transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))"
    return f"if(size(w) < 4, 0L, {let('h', h, f'if(size(array_distinct(h)) = size(h), 0L, {covered(places)})')})"


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED, name: str = "quality") -> DataFrame:
    """``docs`` with ``quality`` (or another ``name``), a struct of the counts, ``base_failed``, ``failed`` and ``kept``.

    Null and empty texts count as having no words: they fail the base. A ratio whose denominator
    is 0 passes its rule. Very long texts are read whole. Every input column stays, also one that
    is called ``quality`` already, which is replaced unless ``name`` is another. Rows are judged one by one, so ties,
    repeated rows and empty tables need no care.
    """
    stop = ", ".join("'" + w.replace("'", "\\'") + "'" for w in STOP_WORDS.split())
    blank = r"[\\x20\\x09-\\x0D]*"
    lines = f"filter(split(coalesce(text, ''), '\\n'), l -> not l rlike '^{blank}$')"
    counts = let(
        "w",
        words_sql(),
        f"""named_struct(
            'n_words', cast(size(w) as bigint),
            'word_chars', cast(length(array_join(w, '')) as bigint),
            'n_stop_words', cast(size(filter(split(lower(array_join(w, ' ')), ' '), x -> x in ({stop}))) as bigint),
            'n_repeat_words', {_repeats_sql()})""",
    )
    line_counts = let("l", lines, "named_struct('n_lines', cast(size(l) as bigint), 'n_dup_lines', cast(size(l) - size(array_distinct(l)) as bigint))")
    symbols = "cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '')) as bigint)"

    def breach(r: Rule) -> str:
        tests = [f"100 * {r.numerator} {op} {bound} * {r.denominator}" for op, bound in (("<", r.low), (">", r.high)) if bound is not None]
        return f"({r.denominator} > 0 and ({' or '.join(tests)}))"

    failed = "array_compact(array(" + ", ".join(f"if({breach(r)}, '{r.name}', null)" for r in rules) + "))" if rules else "cast(array() as array<string>)"
    # One expression from text to verdict, so that a filter on it that is pushed down is evaluated once.
    source = {"n_symbols": f"coalesce({symbols}, 0L)", "n_lines": "k.n_lines", "n_dup_lines": "k.n_dup_lines"}
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words")
    gathered = "named_struct(" + ", ".join(f"'{n}', {source.get(n, f'c.{n}')}" for n in names) + ")"
    judged = f"named_struct({', '.join(f'{n!r}, {n}' for n in names)}, 'base_failed', n_words < {least_words} or 100 * n_repeat_words > {most_repeated} * n_words, 'failed', {failed})"
    full = "named_struct(" + ", ".join(f"'{n}', v.{n}" for n in (*names, "base_failed", "failed")) + ", 'kept', not v.base_failed and size(v.failed) = 0)"
    verdict = let("c", counts, let("k", line_counts, let("q", gathered, let("v", _prefixed(judged, names), full))))
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != name], F.expr(verdict).alias(name))


def _prefixed(sql: str, names: tuple[str, ...]) -> str:
    """``sql`` with each bare count name read from the struct ``q``."""
    return re.sub(r"(?<!['\w.])(" + "|".join(names) + r")(?!['\w])", r"q.\1", sql)


def keep(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass, with all their own columns, also one that is called ``quality``.

    Null and empty texts fail. Rows are judged one by one: repeated ones stay or go together, and an
    empty table stays empty.
    """
    name = spare(docs, "__quality")
    return quality(docs, name=name, **options).where(f"`{name}`.kept").select(*[F.col(f"`{c}`") for c in docs.columns])
