"""Texts, keys and ids, as column expressions."""

from __future__ import annotations

import html
import re
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fixed value: the name space of DNS names for ids derived from names.
NAMESPACE_DNS = "6ba7b8109dad11d180b400c04fd430c8"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def one_line(c: Column) -> Column:
    """Line feeds as blanks, the ends trimmed; other white space stays."""
    return strip(F.replace(c, F.lit("\n"), F.lit(" ")))


@F.pandas_udf(StringType())
def _decoded(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


#: A whole character reference, by number or by name.
_WHOLE = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+);|([A-Za-z][A-Za-z0-9]*;))")


@F.pandas_udf(StringType())
def _decoded_whole(texts: pd.Series) -> pd.Series:
    one = lambda m: html5.get(m[1], m[0]) if m[1] else html.unescape(m[0])
    return texts.map(lambda t: _WHOLE.sub(one, t), na_action="ignore")


def unescape(c: Column, bare: bool = True) -> Column:
    """All character references of HTML decoded, by name and by number, the ends trimmed first.

    As browsers do, ``bare`` decodes some names without their semicolon too; without it what is cut or lacks the semicolon stays as it is.
    The table of names is that of the standard library, so this is an Arrow function; texts come to it in
    batches.
    """
    return (_decoded if bare else _decoded_whole)(strip(c))


def capitalised(c: Column) -> Column:
    """The first letter upper-case, the others lower-case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2**31 - 2)))


def hidden_field(c: Column, name: str) -> Column:
    """The value that follows the id ``name``; empty if there is none."""
    return F.coalesce(F.regexp_extract(c, rf'id="{name}"\s+value="([^"]*)"', 1), F.lit(""))


def grade_of_image(c: Column) -> Column:
    """The grade in an image's name; two dashes mean none."""
    return F.nullif(F.nullif(F.regexp_extract(c, r"Letra(.*?)\.png", 1), F.lit("")), F.lit("--"))


def truncated(c: Column, most: int = 300) -> Column:
    return F.substring(c, 1, most)


def composite_key(*parts: Column) -> Column:
    """Parts joined by colons, a null written as ``None``."""
    return F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])


def name_uuid(name: Column, namespace: str = NAMESPACE_DNS) -> Column:
    """The version 5 UUID of a name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.lit(8).bitwiseOR(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)))))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def listing_id(commune: Column, region: Column, kind: Column, ident: Column) -> Column:
    """The id of a listed report, which is the same at each crawl."""
    return name_uuid(F.concat_ws("_", *[F.coalesce(c.cast("string"), F.lit("None")) for c in (commune, region, kind, ident)]))


def carve(c: Column) -> Column:
    """A document cut out of a payload: from its first head to its last end mark, or to the end."""
    begin = F.instr(c, "%PDF")
    back = F.instr(F.reverse(c), "FOE%%")
    last = F.length(c) - back + 1
    rest = F.substring(c, begin, F.length(c))
    return F.when(begin == 0, F.lit(None).cast("string")).when((back == 0) | (last < begin), rest).otherwise(F.substring(c, begin, last - begin + 1))


def acceptable(status: Column, carved: Column, least: int = 1000) -> Column:
    """A download counts if it went well and holds more than ``least`` bytes."""
    return (status == 200) & F.coalesce(F.octet_length(carved) > least, F.lit(False))


def shown(c: Column, boolean: bool = False) -> Column:
    """How reports of counts show a value: null as a word, booleans capitalised."""
    text = F.initcap(c.cast("string")) if boolean else c.cast("string")
    return F.coalesce(text, F.lit("null"))
