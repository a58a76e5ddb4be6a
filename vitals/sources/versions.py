"""Messages of several schema versions, resolved to one reader's schema inside a batch."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Writer's type to the reader's types that hold all its values.
WIDER = {"int": ("bigint", "float", "double"), "bigint": ("float", "double"), "float": ("double",), "string": ("binary",), "binary": ("string",)}


@dataclass(frozen=True)
class ReaderField:
    """A field as the reader wants it: other names that writers may use, and what stands where a writer has none (``required``: nothing may)."""

    name: str
    type: str
    aliases: tuple[str, ...] = field(default=())
    default: object = None
    required: bool = False


class Incompatible(ValueError):
    """A writer's schema can't be read as the reader's."""


def _resolved(body: Column, writer: StructType, reader: list[ReaderField]) -> Column:
    parsed, types, out = F.from_json(body.cast("string"), writer, {"mode": "PERMISSIVE"}), {f.name: f.dataType for f in writer.fields}, []
    for f in reader:
        name = next((n for n in (f.name, *f.aliases) if n in types), None)
        if name is None:
            if f.required:
                raise Incompatible(f"no {f.name} in the writer's schema, and no default")
            out.append(F.lit(f.default).cast(f.type).alias(f.name))
            continue
        own = types[name].simpleString()
        if own != f.type and f.type not in WIDER.get(own, ()):
            raise Incompatible(f"{name}: {own} can't be read as {f.type}")
        out.append(parsed[name].cast(f.type).alias(f.name))
    return F.when(parsed.isNotNull(), F.struct(*out))


def read_versions(framed: DataFrame, versions: dict[int, str], reader: list[ReaderField]) -> DataFrame:
    """``framed`` (schema_id, body: ``payloads.decode_wire``) with ``record``, the reader's struct, and ``version_error``.

    ``versions``: schema id to the writer's fields as DDL, a few. A record's fields are matched by name, then by alias;
    ints and floats widen, missing ones take the default, the writer's others are left out. A schema that can't be read as
    the reader's is refused before any row is read. An unknown id, a broken frame, a body that isn't the writer's JSON and
    a null in a required field give a ``version_error`` and no record: an error row, not a stopped job.
    """
    record, known = F, F.col("schema_id").isin(*versions)
    for number, ddl in versions.items():
        record = record.when(F.col("schema_id") == number, _resolved(F.col("body"), StructType.fromDDL(ddl), reader))
    missing = [F.col("record")[f.name].isNull() for f in reader if f.required]
    lacking = F.lit(False)
    for m in missing:
        lacking = lacking | m
    rows = framed.withColumn("record", record.otherwise(None))
    error = F.coalesce("wire_error", F.when(~F.coalesce(known, F.lit(False)), "UNKNOWN_SCHEMA"), F.when(F.col("record").isNull(), "DESERIALIZATION_ERROR"), F.when(lacking, "MISSING_FIELD"))
    return rows.withColumn("version_error", error).withColumn("record", F.when(F.col("version_error").isNull(), F.col("record")))
