import random

import pytest

#: Columns that operators might use inside.
CLASHING = "n int, key string, quality string, kept boolean, found string, blob_id string, cls bigint, shard int, weight double, p double, bucket string, pos int, __mix int, text_sha256 string, host string, bad int, component_id bigint, __mark int, __id string, __cell int, __chance string, __quality int, __time int"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, blanks, a very long text, ties, copies and other scripts."""
    random.seed(3)
    words = [f"w{i}" for i in range(300)] + ["the", "of", "and", "naïve", "ÉTÉ", "日本語", "a\u00a0b"]
    long = " ".join(random.choice(words) for _ in range(30_000))
    prose = [" ".join(random.choice(words) for _ in range(n)) for n in (1, 2, 3, 4, 5, 49, 50, 51, 120, 400)]
    texts = [None, "", " ", "\n\n", "\t x \x0b y \f z \r", long, *prose, *prose[5:], "a b a b a b a b", "x\ny\nx\n \nx", "!!! ### $$$", "日本語 テキスト", "\U0001f600 \U0001f600"]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, [None, "en", "fr"][i % 3], [None, "s0", "s0", "s1"][i % 4]))
    rows += [(100, "same row", "en", "s0")] * 3 + [(None, "no id", None, None), (None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with extra columns whose names clash."""
    names = [c.split()[0] for c in CLASHING.split(", ")]
    full = [(*r, *[None] * len(names)) for r in odd_rows]
    return spark.createDataFrame(full, f"doc_id bigint, text string, lang string, source string, {CLASHING}").repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
