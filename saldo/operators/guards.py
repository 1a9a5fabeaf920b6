"""Checks inside a plan and row counts taken on the way."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from saldo.session import staged

PLAIN_FILES = {"compression": "uncompressed", "parquet.enable.dictionary": "false"}


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails if two rows share the key.

    Keys are counted, combined on every task, in a branch that yields no row and raises on the first
    repeated key. The branch carries the first real values of its columns: with constants there, a
    join that follows would prove it empty and drop the check. The rows themselves are not shuffled
    for the check, so a join still shuffles both its sides and AQE can split a hot key.
    """
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit(f"not unique on {', '.join(keys)}: "), shown)
    others = [F.first(c).alias(c) for c in df.columns if c not in keys]
    repeated = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *others)
        .filter(F.when(F.col("_rows") > 1, F.raise_error(message).cast("boolean")).otherwise(False))
        .select(*df.columns)
    )
    return df.unionByName(repeated)


def counted(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """Count rows of a step while it runs; read ``observation.get["rows"]`` after an action."""
    observation = Observation(step)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def rows_seen(observation: Observation) -> int:
    """Rows that a step counted, after its action has ended well. Where Spark proves a step empty while
    it runs, it drops the counter with it and has no row to give; the step had none either."""
    try:
        return observation.get["rows"]
    except Py4JJavaError:
        return 0


def dimension(df: DataFrame, name: str = "dimension") -> DataFrame:
    """A derived dimension for joins with a ledger, worked out once and written to the shared folder.
    Its uniqueness checks run there, and the planner sees its real size instead of a product of
    estimates: below the broadcast limit it is broadcast, beyond it both sides are shuffled.

    The planner goes by the size of the files, and a table that repeats its texts (an account in every
    set and year) can take a hundred times its files in memory, on the driver first. So dimensions are
    written plain: values as they are, neither compressed nor as numbers of a dictionary."""
    return staged(df, name, **PLAIN_FILES)
