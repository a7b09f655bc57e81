"""Export in waves: documents by source, measured in bytes of text by steps of 16 ids."""

from pyspark.sql import functions as F

from relocate.checks import fixtures as fx
from relocate.checks import query
from relocate.operators import waves
from relocate.plans import job as plan
from relocate.session import saved, work_folder
from relocate.specs import TableSpec

DOCUMENTS = TableSpec("documents", partition="source")
SMALL_CAP, CAP = 200_000, 1_000_000
STEP = 16


def _placed(documents, cap):
    step = F.floor(F.col("doc_id") / STEP).cast("bigint")
    return saved(waves.place(waves.key_steps(documents, F.col("source"), step, F.octet_length("text")), cap), "placed")


def _sql_pieces(size):
    """Pieces of at most a slice's size."""
    limit = SMALL_CAP // waves.GRAIN
    return f"greatest(({size} + {limit - 1}) // {limit}, 1)"


_SQL_CUT = f"""
SELECT partition, step, part, parts, (part + 1) * bytes // parts - part * bytes // parts AS b,
       least(begin * {_sql_pieces('total')} // greatest(total, 1), {_sql_pieces('total')} - 1) AS share
FROM (SELECT *, {_sql_pieces('bytes')} AS parts, unnest(range({_sql_pieces('bytes')})) AS part
      FROM (SELECT *, sum(bytes) OVER (PARTITION BY partition) AS total,
                   sum(bytes) OVER (PARTITION BY partition ORDER BY step NULLS FIRST) - bytes AS begin
            FROM (SELECT source AS partition, doc_id // {STEP} AS step,
                         CAST(sum(coalesce(strlen(text), 0)) AS BIGINT) AS bytes
                  FROM documents GROUP BY 1, 2)))"""


@query(
    "export_waves",
    f"""
WITH slices AS (SELECT partition, part, parts, min(step) AS low, max(step) AS high, sum(b) AS bytes
                FROM ({_SQL_CUT}) GROUP BY partition, share, parts > 1, step IS NULL, part, parts),
count_of AS (SELECT greatest((sum(bytes) + {SMALL_CAP} - max(bytes) - 1) // ({SMALL_CAP} - max(bytes)), 1) AS n,
                    greatest(sum(bytes), 1) AS total FROM slices)
SELECT CAST(least(before * n // total, n - 1) AS BIGINT) AS wave, partition, slice, CAST(part AS BIGINT) AS part,
       CAST(parts AS BIGINT) AS parts, low, high, CAST(bytes AS BIGINT) AS bytes
FROM (SELECT *, sum(bytes) OVER (ORDER BY partition NULLS FIRST, low NULLS FIRST, part) - bytes AS before,
             row_number() OVER (PARTITION BY partition ORDER BY low NULLS FIRST, part) - 1 AS slice FROM slices), count_of""",
)
def export_waves(spark, folder):
    """Slices of the sources and their waves."""
    return waves.slices(_placed(fx.table(spark, folder, "documents"), SMALL_CAP))


@query("relocate_in_waves", "SELECT * FROM documents")
def relocate_in_waves(spark, folder):
    """Wave after wave staged and loaded, those of a round by the same jobs."""
    documents = fx.table(spark, folder, "documents")
    job = plan.Job("waves", "db", *(work_folder(spark, name) for name in ("stage", "target", "ledger")))
    step = F.floor(F.col("doc_id") / STEP).cast("bigint")
    placed = _placed(documents, CAP)
    for some in waves.rounds(placed):
        rows = waves.round_rows(documents, F.col("source"), step, ["doc_id", "text"], placed, some)
        plan.move_waves(rows, DOCUMENTS, job, some)
    return plan.loaded_table(spark, documents.schema, DOCUMENTS, job)
