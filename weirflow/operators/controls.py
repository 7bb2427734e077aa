"""Control tables: how many rows each input file gave."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expectations import FAILED_COLUMN
from .transforms import DATE_COLUMN, ENTITY_COLUMN, FILE_COLUMN, TIME_COLUMN


def file_counts(
    df: DataFrame,
    file_column: str = FILE_COLUMN,
    by: Sequence[str] = (ENTITY_COLUMN, DATE_COLUMN, TIME_COLUMN),
) -> DataFrame:
    """Rows per file, entity and ingestion."""
    return (
        df.groupBy(file_column, *by)
        .agg(F.count(F.lit(1)).alias("records"))
        .select(F.col(file_column).alias("fileName"), "records", *by)
    )


def loaded_vs_rejected(
    silver: DataFrame,
    quarantined: DataFrame,
    id_column: str = "id",
    file_column: str = FILE_COLUMN,
    by: Sequence[str] = (DATE_COLUMN, TIME_COLUMN),
) -> DataFrame:
    """Loaded and rejected ids per file and ingestion.

    Both sides are counted before they meet, so what is joined is a few rows per
    file however large the file is. As the definition has it, only the file
    decides which counts meet: a file with no rejects has NULL ``rows_KO``, one
    with rejects only is missing, and one ingested several times shows each
    loaded count with each rejected count. `file_reconciliation` has none of that.
    """
    loaded = silver.groupBy(file_column, *by).agg(F.count(id_column).alias("rows_OK"))
    rejected = (
        quarantined.groupBy(file_column, *by)
        .agg(F.count(id_column).alias("rows_KO"))
        .select(file_column, "rows_KO")
    )
    return loaded.join(rejected, file_column, "left").select(
        file_column, *by, "rows_OK", "rows_KO"
    )


def file_reconciliation(
    silver: DataFrame,
    quarantined: DataFrame,
    file_column: str = FILE_COLUMN,
    by: Sequence[str] = (DATE_COLUMN, TIME_COLUMN),
    id_column: str | None = None,
) -> DataFrame:
    """Rows loaded and rejected per file and ingestion, zeros included.

    A full outer join of the two counts in effect, done as one aggregate over
    both inputs: one shuffle of counts, no join. With an ``id_column`` the ids
    are counted too, and `control_of_counts` makes the control table of that.
    """
    columns = [file_column, *by, *([id_column] if id_column else [])]
    sides = silver.select(*columns, F.lit(True).alias("_ok")).union(
        quarantined.select(*columns, F.lit(False).alias("_ok"))
    )
    return _sides_counted(sides, F.col("_ok"), [file_column, *by], id_column)


def reconciliation_of_labelled(
    labelled: DataFrame,
    failed_column: str = FAILED_COLUMN,
    file_column: str = FILE_COLUMN,
    by: Sequence[str] = (DATE_COLUMN, TIME_COLUMN),
    id_column: str | None = None,
) -> DataFrame:
    """`file_reconciliation` of rows that carry the names of the rules they break."""
    ok = F.size(failed_column) == 0
    return _sides_counted(labelled, ok, [file_column, *by], id_column)


def control_of_counts(
    counts: DataFrame,
    file_column: str = FILE_COLUMN,
    by: Sequence[str] = (DATE_COLUMN, TIME_COLUMN),
) -> DataFrame:
    """`loaded_vs_rejected` from stored counts that include ids.

    ``counts`` is read twice, so it should be a table: then the rows themselves
    have been read only once, for both control tables.
    """
    loaded = counts.filter("rows_OK > 0").select(file_column, *by, F.col("ids_OK").alias("rows_OK"))
    rejected = counts.filter("rows_KO > 0").select(file_column, F.col("ids_KO").alias("rows_KO"))
    return loaded.join(rejected, file_column, "left").select(
        file_column, *by, "rows_OK", "rows_KO"
    )


def _sides_counted(
    rows: DataFrame, ok: Column, keys: Sequence[str], id_column: str | None
) -> DataFrame:
    counts = [F.count_if(ok).alias("rows_OK"), F.count_if(~ok).alias("rows_KO")]
    if id_column:
        has_id = F.col(id_column).isNotNull()
        counts += [
            F.count_if(ok & has_id).alias("ids_OK"),
            F.count_if(~ok & has_id).alias("ids_KO"),
        ]
    return rows.groupBy(*keys).agg(*counts)
