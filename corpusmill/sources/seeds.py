"""A few hand-written pairs that join every data set, one per task type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.fixed_values import SOURCE_SEED

_COLUMNS = "task_type string, instruction string, input string, output string"

DEFAULT_SEEDS = [
    (
        "rtl_explanation",
        "Explain what this edge detector does and when its output is high.",
        "module rise(input clk, input d, output q);\n  reg last;\n"
        "  always @(posedge clk) last <= d;\n  assign q = d & ~last;\nendmodule",
        "The module remembers the previous sample of d and raises q for the one "
        "cycle in which d is high and was low before.",
    ),
    (
        "sva_assertion_generation",
        "Write an assertion that a grant is only given after a request.",
        "module arb(input clk, input req, output gnt);\n  assign gnt = req;\nendmodule",
        "module arb_checks(input clk, input req, input gnt);\n"
        "  assert property (@(posedge clk) gnt |-> req);\nendmodule",
    ),
    (
        "register_map_qa",
        "Document a timer block with LOAD (RW, 0x0), VALUE (RO, 0x4) and CTRL (RW, 0x8).",
        "Timer register list.",
        "| Offset | Name | Access |\n|---|---|---|\n"
        "| 0x0 | LOAD | RW |\n| 0x4 | VALUE | RO |\n| 0x8 | CTRL | RW |",
    ),
]


def seed_pairs(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    seeds = spark.createDataFrame(DEFAULT_SEEDS if rows is None else rows, _COLUMNS)
    return seeds.withColumn("source", F.lit(SOURCE_SEED))
