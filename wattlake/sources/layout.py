"""Files laid out for lookups: rows clustered by a key inside each date, pinned row groups, Bloom filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.sources.lake import FILE_OPTIONS

#: Small enough that a lookup reads little, large enough for good compression.
LOOKUP_GROUP_BYTES = 16 << 20


def write_clustered(
    rows: DataFrame, path: str, date: str, key: str, bloom: Sequence[str] = (), group_bytes: int = LOOKUP_GROUP_BYTES, files_a_date: int = 1,
    group_rows: int | None = None,
) -> None:
    """Writes ``rows`` partitioned by ``date``, each file sorted by ``key`` and holding a range or hash share of the keys.

    A date's rows are dealt over ``files_a_date`` files by their keys' hash, so one key of a date is in one file and, as files
    are sorted, in neighbouring row groups. Row groups are of ``group_bytes``, or sooner of ``group_rows`` rows.
    ``bloom`` names columns that get a Bloom filter in each row group.
    """
    options = FILE_OPTIONS | {"parquet.block.size": str(group_bytes)}
    if group_rows is not None:
        options |= {"parquet.block.row.count.limit": str(group_rows)}
    options |= {f"parquet.bloom.filter.enabled#{name}": "true" for name in bloom}
    share = F.pmod(F.xxhash64(key), F.lit(files_a_date))
    placed = rows.repartition(F.col(date), share).sortWithinPartitions(date, key)
    placed.write.mode("append").options(**options).partitionBy(date).parquet(path)
