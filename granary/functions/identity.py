"""Content-derived identities."""

from __future__ import annotations

import dataclasses
import enum
import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _portable(x):
    """What JSON has no form of its own for."""
    if isinstance(x, enum.Enum):
        return x.value
    if dataclasses.is_dataclass(x):
        return dataclasses.asdict(x)
    raise TypeError(f"no canonical form of {type(x).__name__}")


def canonical_json(value) -> str:
    """Deterministic JSON of plain values, enums and dataclasses (control plane: configurations, task graphs)."""
    return json.dumps(value, default=_portable, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def content_id(prefix: str, value) -> str:
    return f"{prefix}_{hashlib.sha256(canonical_json(value).encode()).hexdigest()}"


def row_json(**fields: Column) -> Column:
    """Canonical JSON of a row's declared fields; null differs from absent."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def row_id(prefix: str, **fields: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.sha2(row_json(**fields), 256))


def key_id(*parts: Column | str) -> Column:
    """Digest of parts joined by a bar, as SQL can write it."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def packed(x: Column) -> Column:
    """An id as bytes, one to one and for joins: a digest as its own 32 after a 0, anything else as UTF-8 after a 1."""
    byte = lambda n: F.lit(bytearray([n]))
    return F.when(x.rlike("^[0-9a-f]{64}\\z"), F.concat(byte(0), F.unhex(x))).otherwise(F.concat(byte(1), x.cast("binary")))


def packed_key(name: str, null: int = 2) -> Column:
    """packed(), but never null: the planner would test a join's key for null, which hashes every row once more. Null becomes a byte
    that no packed id is; of two sides that both may hold it, each takes its own."""
    return F.coalesce(packed(F.col(name)), F.lit(bytearray([null])))


def unpacked(x: Column) -> Column:
    rest = F.substring(x, 2, 1 << 30)
    return F.when(F.hex(F.substring(x, 1, 1)) == "00", F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def table_hash(df: DataFrame, *columns: str, buckets: int = 256) -> DataFrame:
    """One row, `hash`: independent of row order. Rows are digested, then buckets of digests, so no task gathers them all."""
    row = df.select(F.sha2(F.to_json(F.struct(*sorted(columns or df.columns)), {"ignoreNullFields": "false"}), 256).alias("d"))
    part = row.groupBy(F.conv(F.substring("d", 1, 4), 16, 10).cast("int").alias("b"), F.substring("d", 1, 8).alias("p")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ""), 256).alias("d"))
    part = part.groupBy((F.col("b") % buckets).alias("b")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ""), 256).alias("d"))
    return part.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ""), 256).alias("hash"))


def build_id(stage: str, version: str, contract: str, config, input_hash: str) -> dict[str, str]:
    """Identity of one run of a stage."""
    config_hash = hashlib.sha256(canonical_json(config).encode()).hexdigest()
    fields = {"compiler": stage, "version": version, "contract": contract, "config_hash": config_hash, "input_hash": input_hash}
    return fields | {"build_id": content_id("cbuildv0", fields)}
