"""Deeply nested records as related flat tables, by their Arrow buffers.

No record is parsed row by row in Python: the structs are walked to each list column, list offsets give the lengths, the
longest of the parallel lists gives the slots, and keys and values reach their slots by vectorised take. Records that come
as JSON are parsed to variants and brought into the same nested columns by expressions, before the same Arrow path. Of a
record sent several times the one received last counts, for the parent and its children alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.runtime import prepare, table

FAMILIES = ("text", "images", "structured")
PARTS = ("content", "bbox", "type")
LEVELS = ("page_count", "page", "block", "line", "span")
#: Layers of wrapping (keys, lists of one, JSON in a string) that are taken off a JSON record.
LAYERS = 12
OBJECT_SCHEMA = "record_id bigint, family string, pos bigint, content string, bbox array<double>, type string"


def _lists(a: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Start and length of each list (0 for a null one) and the values they index."""
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks()
    off = a.offsets.to_numpy().astype(np.int64)
    size = np.diff(off)
    size[a.is_null().to_numpy(zero_copy_only=False)] = 0
    return off[:-1], size, a.values


def flatten_objects(keys: pa.Array, nearby: pa.StructArray) -> pa.RecordBatch:
    """The objects of all families of a batch: (record_id, family, pos, content, bbox, type). An object is there where at
    least one of its parts is; a list that ends early gives nulls."""
    out = []
    for family in FAMILIES:
        sub = pc.struct_field(nearby, family)
        lists = [_lists(pc.struct_field(sub, p)) for p in PARTS]
        slots = np.max([size for _, size, _ in lists], axis=0)
        parent = np.repeat(np.arange(len(slots)), slots)
        pos = np.arange(len(parent)) - np.repeat(np.cumsum(slots) - slots, slots)
        columns = []
        for start, size, values in lists:
            inside = pos < size[parent]
            columns.append(values.take(pa.array(np.where(inside, start[parent] + pos, 0), pa.int64(), mask=~inside)))
        there = pc.or_(pc.or_(columns[0].is_valid(), columns[1].is_valid()), columns[2].is_valid())
        at = pa.array(parent, pa.int64())
        rows = pa.RecordBatch.from_arrays([keys.take(at), pa.array([family]).take(pa.array(np.zeros(len(parent), np.int64))), pa.array(pos, pa.int64()), *columns], names=["record_id", "family", "pos", *PARTS])
        out.append(rows.filter(there))
    return pa.Table.from_batches(out).combine_chunks()


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _is(v: Column, kind: str) -> Column:
    """Whether a variant is an 'object' or an 'array', without a walk through all of it."""
    return _get(v, "$", {"object": "map<string, variant>", "array": "array<variant>"}[kind]).isNotNull()


def _scalar(v: Column) -> Column:
    return F.when(~_is(v, "object") & ~_is(v, "array"), F.schema_of_variant(v))


def _unwrapped(v: Column) -> Column:
    """One layer taken off a JSON record, or the record itself where there is none; null for what can't be one."""
    inner = lambda k: _get(v, f"$.{k}", "variant")
    wraps = lambda k: _is(inner(k), "object") | _is(inner(k), "array") | F.coalesce(F.schema_of_variant(inner(k)) == "STRING", F.lit(False))
    return (
        F.when(_is(v, "object"), F.when(wraps("content_metadata"), inner("content_metadata")).when(wraps("metadata"), inner("metadata")).otherwise(v))
        .when(_is(v, "array"), F.when(F.size(_get(v, "$", "array<variant>")) == 1, _get(v, "$[0]", "variant")))
        .when(F.schema_of_variant(v) == "STRING", F.try_parse_json(_get(v, "$", "string")))
    )


def content_metadata_of(raw: Column) -> Column:
    """The content metadata in a JSON text as a variant, out of whatever wraps it; null if it doesn't parse."""
    v = F.aggregate(F.sequence(F.lit(1), F.lit(LAYERS)), F.try_parse_json(raw), lambda acc, _: _unwrapped(acc))
    return F.when(_is(v, "object"), v)


def _box(v: Column) -> Column:
    """A list of numbers, or an object of the four edges; what is no number is null."""
    edges = F.filter(F.array(*[F.named_struct(F.lit("v"), _get(v, f"$.{k}", "variant")) for k in ("x0", "y0", "x1", "y1")]), lambda e: e.v.isNotNull())
    number = lambda x: F.when(F.schema_of_variant(x) != "STRING", _get(x, "$", "double"))
    listed = F.transform(_get(v, "$", "array<variant>"), number)
    return F.coalesce(listed, F.when(_is(v, "object"), F.transform(edges, lambda e: number(e.v))))


def _boxes(v: Column) -> Column:
    """A list of boxes; one box in place of a list is a list of one."""
    items = _get(v, "$", "array<variant>")
    numbers = (F.size(items) > 0) & ~F.exists(items, lambda x: ~F.coalesce(_scalar(x).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False)))
    return F.when(items.isNotNull() & ~numbers, F.transform(items, _box)).when(v.isNotNull(), F.filter(F.array(_box(v)), lambda b: b.isNotNull() & ~F.schema_of_variant(v).isin("STRING", "BOOLEAN", "VOID")))


def _strings(v: Column) -> Column:
    """A list of texts; a single value in place of a list is a list of one."""
    one = _get(v, "$", "string")
    return F.coalesce(_get(v, "$", "array<string>"), F.when(one.isNotNull(), F.array(one)))


def _sub(v: Column) -> Column:
    """One family: parallel lists, a list of objects, or a single value in place of a list."""
    items = _get(v, "$", "array<variant>")
    of = lambda x, k: _get(x, f"$.{k}", "variant")
    objects = F.struct(
        F.transform(items, lambda x: F.when(_is(x, "object"), _get(x, "$.content", "string")).otherwise(_get(x, "$", "string"))).alias("content"),
        F.transform(items, lambda x: _box(of(x, "bbox"))).alias("bbox"),
        F.transform(items, lambda x: _get(x, "$.type", "string")).alias("type"),
    )
    lists = F.struct(_strings(of(v, "content")).alias("content"), _boxes(of(v, "bbox")).alias("bbox"), _strings(of(v, "type")).alias("type"))
    none = F.lit(None)
    single = F.struct(F.array(_get(v, "$", "string")).alias("content"), none.cast("array<array<double>>").alias("bbox"), none.cast("array<string>").alias("type"))
    return F.when(_is(v, "array"), objects).when(_is(v, "object"), lists).when(F.schema_of_variant(v) == "STRING", single)


SUB = "struct<content: array<string>, bbox: array<array<double>>, type: array<string>>"


def received_last(records: DataFrame) -> DataFrame:
    """Each record once: the row received last, of equals the one with the greatest hash of its metadata."""
    have = [c for c in ("received_at",) if c in records.columns]
    mark = F.xxhash64(F.to_json(F.struct("content_metadata")), "raw_metadata")
    w = W.partitionBy("record_id").orderBy(*[F.desc_nulls_last(c) for c in have], mark)
    return records.where("record_id is not null").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def with_nearby(records: DataFrame) -> DataFrame:
    """The rows with `parsed`, the metadata of a JSON record as a variant, and `nearby`, the nested objects of either form."""
    c = F.col("content_metadata")
    r = records.withColumn("parsed", F.when(c.isNull(), content_metadata_of(F.col("raw_metadata"))))
    r = r.withColumn("_near", _get(F.col("parsed"), "$.hierarchy.nearby_objects", "variant"))
    families = [F.when(c.isNotNull(), c["hierarchy"]["nearby_objects"][f].cast(SUB)).otherwise(_sub(_get(F.col("_near"), f"$.{f}", "variant"))).alias(f) for f in FAMILIES]
    return r.withColumn("nearby", F.struct(*families)).drop("_near")


def _objects(batches):
    for batch in batches:
        if batch.num_rows:
            yield from flatten_objects(batch.column(0), batch.column(1)).to_batches()


def nearby_objects(records: DataFrame) -> DataFrame:
    """(record_id, family, pos, content, bbox, type) of all nearby objects of (record_id, content_metadata, raw_metadata).

    Each object once; of a record sent several times the row received last counts (received_at may be missing). Records
    without metadata, that don't parse, or with a null id have no objects; null levels and lists are empty; an empty table
    gives an empty result.
    """
    prepare(records.sparkSession)
    return with_nearby(received_last(records)).select("record_id", "nearby").mapInArrow(_objects, OBJECT_SCHEMA)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearby_objects(table(spark, sf_dir, "extractions")).select("record_id", "family", "pos")


def p3_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearby_objects(table(spark, sf_dir, "extractions"))


def p3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parent table: one row a record, the one received last, its scalar levels out of either form."""
    c, v = F.col("content_metadata"), F.col("parsed")
    r = with_nearby(received_last(table(spark, sf_dir, "extractions")))
    either = lambda native, path, kind: F.coalesce(native.cast(kind), _get(v, path, kind))
    levels = [either(c["hierarchy"][k], f"$.hierarchy.{k}", "int").alias(k) for k in LEVELS]
    return r.select("record_id", either(c["type"], "$.type", "string").alias("type"), either(c["page_number"], "$.page_number", "int").alias("page_number"), *levels, "source_id", "document_type", "received_at")


QUERIES = {"p3_found": p3_found, "p3_objects": p3_objects, "p3_records": p3_records}
