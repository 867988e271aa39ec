import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from threadloom.llm import resampling


def test_readers_of_blocks_hold_a_few(spark):
    docs = spark.range(0, 20 * 1024, 1, 1).select(F.col("id").alias("doc_id"), F.lit("some few words").alias("text"))
    blocks = resampling.csr_blocks(docs, "csr-groups")
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{blocks.inputFiles()[0].removeprefix('file://').rsplit('/', 1)[0]}/*.parquet")]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(groups) >= 20 and max(groups) <= resampling.GROUP_BLOCKS
    assert resampling.column_sums(blocks).sum() == 3 * 20 * 1024
