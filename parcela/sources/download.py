"""Downloads, grouped so that one search serves many reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import groupby
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = ("region_id", "comuna_id", "tipo")


class Session(Protocol):
    """A search that was made; gives (HTTP status, payload) of the reports that it found."""

    def fetch(self, code: str) -> tuple[int, bytes]: ...


def downloads(work: DataFrame, search: Callable[[tuple], Session], key: str = "eval_id", code: str = "codigo_informe", unit: Sequence[str] = UNIT, most: int = 500) -> DataFrame:
    """(key, status, payload, error) of each row of ``work``, with one search for up to about ``most`` reports of a unit.

    Units with more are cut by a hash of the key, so that no unit is one task's alone. A row without a code has no
    status and no payload; one that fails has its error, and the others go on. The next row of a session that failed to open tries
    again. Payloads are what the site sent: ``files.carved`` and ``strings.acceptable`` judge them.
    """
    sizes = work.groupBy(*unit).agg(F.ceil(F.count("*") / F.lit(most)).alias("__pieces"))
    dealt = work.join(sizes, list(unit)).withColumn("__piece", F.pmod(F.xxhash64(key), F.col("__pieces")))
    n = max(1, int(work.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = dealt.repartition(n, *unit, "__piece").sortWithinPartitions(*unit, "__piece", key).select(*unit, "__piece", key, code)
    kind = dict(work.dtypes)[key]

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            yield from b.to_pylist()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, group in groupby(flat(batches), key=lambda r: (*[r[u] for u in unit], r["__piece"])):
            session = None
            for r in group:
                status = payload = error = None
                if r[code] is not None:
                    try:
                        session = session or search(place[:-1])
                        status, payload = session.fetch(r[code])
                    except Exception as e:  # noqa: BLE001  one report's failure must not end the others
                        error = str(e)[:300]
                fields = [(r[key], None), (status, pa.int32()), (payload, pa.binary()), (error, pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in fields], [key, "status", "payload", "error"])

    return rows.mapInArrow(each, f"{key} {kind}, status int, payload binary, error string")
