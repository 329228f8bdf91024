"""An incremental crawl's early stop over a stream of its pages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StructField, StructType


def visited(pages: DataFrame, unit: Sequence[str], order: str, grace: int = 2, rows: str = "n_rows", new: str = "n_new") -> DataFrame:
    """The pages of a stream that a crawl visits before it stops early, with ``stops`` at the page where it does.

    The rule is that of ``directory.early_stop``. A unit's state is how many pages in a row had rows but nothing new, its last
    page, and whether it has stopped; so it takes the same few bytes however many pages there are. Pages of a unit come
    in the order of ``order`` from batch to batch, in any order within one; one that is not behind the last is a repetition and is left out.
    """
    schema = StructType([*pages.schema.fields, StructField("stops", BooleanType())])
    names = schema.fieldNames()

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        dry, last, stopped = state.get if state.exists else (0, None, False)
        every = pd.concat(list(frames)).sort_values(order)
        out = []
        for row in every.to_dict("records"):
            if stopped or (last is not None and row[order] <= last):
                continue
            last = row[order]
            if row[rows] > 0:
                dry = 0 if row[new] > 0 else dry + 1
                stopped = dry >= grace
            out.append({**row, "stops": stopped})
        state.update((dry, None if last is None else int(last), stopped))
        if out:
            yield pd.DataFrame(out, columns=names)

    return pages.groupBy(*unit).applyInPandasWithState(step, schema, "dry int, last bigint, stopped boolean", "append", GroupStateTimeout.NoTimeout)
