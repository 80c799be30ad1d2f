"""Payload files: a JSON array of payload objects, or one object, per file.

The reader keeps one row per file until it has classified the file, which is
what the file-level rules need (an empty array or one bad element fails the
whole file):

* the whole text is parsed once, as the first element of an array whose
  second element is a number derived from the text. Exactly these two must
  come out, so anything after the first value (a second object, JSON Lines)
  makes the file invalid instead of being dropped; white space around the
  value, a final line end included, does not matter;
* malformed JSON -> failed ``Invalid JSON format``; a top-level scalar ->
  ``Unexpected JSON format``; ``[]`` -> ``No payloads found in file``; an
  element that is not an object -> the whole file fails with the error the
  reference job reports for it;
* an array beyond the VARIANT size limit is read by Spark's streaming JSON
  reader, and its elements become VARIANTs one by one; a single object beyond
  it cannot be held and fails with a reason of its own;
* zero-byte files, which every Spark scan skips, are found from the listing
  and reported as invalid JSON.

Good files become one row per payload with its ordinal, unusable ones one row
with the error, in one table, so a file is parsed once. Unknown keys stay in
the VARIANT payload; PII fields are read as text only when their JSON value
is a string (numbers, nulls, objects are not scanned). Whole-file reads
cannot be split, so parallelism comes from the number of files.

JSON Lines files have a reader of their own: one payload a line, splittable,
and a line that is no JSON object is set apart on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clock

# The messages of unusable files.
INVALID = "Invalid JSON format"
UNEXPECTED = "Unexpected JSON format"
NO_PAYLOADS = "No payloads found in file"

# Not of the reference, whose parser has no such limit.
TOO_LARGE = "Payload beyond the size limit of a VARIANT"

FORMATS = ("json", "jsonl")


def _py_type_name(ty: str) -> str:
    """Python type name of a JSON value from its VARIANT schema string."""
    return (f"CASE WHEN {ty} LIKE 'ARRAY%' THEN 'list' WHEN {ty} = 'STRING' THEN 'str' "
            f"WHEN {ty} = 'BOOLEAN' THEN 'bool' WHEN {ty} = 'VOID' THEN 'NoneType' "
            f"WHEN {ty} IN ('DOUBLE', 'FLOAT') OR {ty} LIKE 'DECIMAL%' THEN 'float' "
            f"ELSE 'int' END")


def normalise_path(c: Column) -> Column:
    """``file:///x`` and ``file:/x`` name the same file."""
    return F.regexp_replace(c, r"^file:/+", "file:/")


def not_object(ty: str) -> Column:
    """The error for a payload of another JSON type (its VARIANT schema string)."""
    return F.concat(F.lit("'"), F.expr(_py_type_name(ty)), F.lit("' object has no attribute 'get'"))


def classify_files(raw: DataFrame, path_col: str | None = None) -> DataFrame:
    """Per file: source_file, arr (array<variant> of payloads), error and the
    clock when the task began with it.

    ``raw`` is a whole-file text read (``value``); the file path comes from
    the hidden ``_metadata`` column unless ``path_col`` names one.

    A scan gives small files a task for every few of them, and setting up a
    task of the detection behind it costs more than such files do: so many
    files share a task, up to the session's number of shuffle partitions.
    Nothing is shuffled, and a file stays in the task that read it.
    """
    path = F.col(path_col) if path_col else F.col("_metadata.file_path")
    files = raw.select(normalise_path(path).alias("source_file"),
                       F.col("value").alias("content"), clock().alias("began"))
    files = files.coalesce(int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # [<content>,<check>]: the check number cannot stand in the content it is made from
    files = files.withColumn("check", F.xxhash64("content"))
    files = files.withColumn("wrapped", F.concat(F.lit("["), "content", F.lit(","), F.col("check").cast("string"), F.lit("]")))
    files = files.withColumn("pair", F.expr("try_cast(try_parse_json(wrapped) AS array<variant>)"))
    files = files.withColumn("v", F.when(
        (F.size("pair") == 2) & (F.expr("try_variant_get(pair[1], '$', 'bigint')") == F.col("check")), F.expr("pair[0]")))
    files = files.withColumn("ty", F.schema_of_variant("v"))
    # beyond the VARIANT limit: the same check on the raw first element (raw for arrays and objects, so the kind is
    # read from the content); the elements of an array then become VARIANTs one by one and keep their JSON types
    files = files.withColumn("texts", F.when(
        F.col("pair").isNull() & (F.octet_length("content") > LARGE), F.from_json("wrapped", "array<string>")))
    whole = (F.size("texts") == 2) & (F.expr("texts[1]") == F.col("check").cast("string"))
    files = files.withColumn("large", F.when(
        whole & F.col("content").rlike(r"^[ \t\r\n]*\["), F.from_json(F.expr("texts[0]"), "array<variant>")))
    files = files.withColumn("too_large", F.coalesce(whole & F.col("content").rlike(r"^[ \t\r\n]*\{"), F.lit(False)))
    files = files.withColumn("arr", F.expr(
        "CASE WHEN ty LIKE 'ARRAY%' THEN cast(v AS array<variant>) "
        "WHEN ty LIKE 'OBJECT%' THEN array(v) "
        "WHEN large IS NOT NULL THEN large END"))
    files = files.withColumn("fb_ty", F.schema_of_variant(F.try_element_at(
        F.filter("arr", lambda e: ~F.coalesce(F.schema_of_variant(e).startswith("OBJECT"), F.lit(False))), F.lit(1))))
    error = (
        F.when(F.col("too_large"), F.lit(TOO_LARGE)).when(F.col("v").isNull() & F.col("large").isNull(), F.lit(INVALID))
        .when(F.col("arr").isNull(), F.lit(UNEXPECTED))
        .when(F.size("arr") == 0, F.lit(NO_PAYLOADS))
        .when(F.col("fb_ty").isNotNull(), not_object("fb_ty"))
        .when(F.exists("arr", lambda e: e.isNull()), F.lit(INVALID))
    )
    return files.select("source_file", "arr", error.alias("error"), "began")


#: Texts above this many bytes get a second chance if they are no VARIANT.
LARGE = 8 << 20


def payload_rows(files: DataFrame) -> DataFrame:
    """``classify_files`` -> source_file, payload_ordinal, payload, error: a row
    per payload of a good file, one row with only the error for another."""
    good = F.when(F.col("error").isNull(), F.col("arr"))
    return files.select("source_file", "error", "began", F.posexplode_outer(good).alias("payload_ordinal", "payload")) \
        .select("source_file", "payload_ordinal", "payload", "error", "began")


def empty_files(raw: DataFrame, seen: DataFrame) -> DataFrame:
    """Error rows for the files of ``raw`` that no scan has seen (the listing
    passes through the driver; ``manifest`` avoids that)."""
    listed = raw.sparkSession.createDataFrame([(p,) for p in raw.inputFiles()], "f string")
    return listed.select(normalise_path(F.col("f")).alias("source_file")).join(
        seen.select("source_file").distinct(), "source_file", "left_anti").select(
        "source_file", F.lit(INVALID).alias("error"))


def read_payload_files(spark: SparkSession, paths, fmt: str = "json", manifest: DataFrame | None = None) -> DataFrame:
    """source_file, payload_ordinal, payload (VARIANT object), error, began (clock).

    ``fmt``: ``json`` (one array or object per file) or ``jsonl`` (one object
    per line; a bad line is a row of its own with an error and an ordinal).
    ``manifest``: optional table of the expected files (``source_file``), used
    instead of the driver's listing to find files that hold nothing; give one
    where there are millions of files.
    """
    if fmt not in FORMATS:
        raise ValueError(f"Unknown format '{fmt}'. Available: {list(FORMATS)}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "jsonl":
        return read_payload_lines(spark, paths)
    raw = spark.read.text(paths, wholetext=True)
    rows = payload_rows(classify_files(raw))
    seen = raw.select(normalise_path(F.col("_metadata.file_path")).alias("source_file"))
    if manifest is None:
        empty = empty_files(raw, seen)
    else:
        listed = manifest.select(normalise_path(F.col("source_file")).alias("source_file"))
        empty = listed.join(seen, "source_file", "left_anti").select("source_file", F.lit(INVALID).alias("error"))
    return rows.unionByName(empty, allowMissingColumns=True)


def read_payload_lines(spark: SparkSession, paths) -> DataFrame:
    """JSON Lines: like ``read_payload_files``; blank lines are skipped.

    ``payload_ordinal`` is the byte offset of the line's block and the line's
    number in it, in file order, so files stay splittable.
    """
    lines = spark.read.text(paths).where(F.length(F.regexp_replace("value", r"[ \t\r\n]+", "")) > 0)
    lines = lines.select(
        normalise_path(F.col("_metadata.file_path")).alias("source_file"),
        (F.col("_metadata.file_block_start") * F.lit(1 << 24) + F.monotonically_increasing_id() % F.lit(1 << 33)).alias("payload_ordinal"),
        F.xxhash64("value").alias("check"), "value", clock().alias("began"))
    lines = lines.withColumn("pair", F.expr(
        "try_cast(try_parse_json(concat('[', value, ',', cast(check AS string), ']')) AS array<variant>)"))
    lines = lines.withColumn("v", F.when(
        (F.size("pair") == 2) & (F.expr("try_variant_get(pair[1], '$', 'bigint')") == F.col("check")), F.expr("pair[0]")))
    lines = lines.withColumn("ty", F.schema_of_variant("v"))
    error = F.when(F.col("v").isNull(), F.lit(INVALID)).when(~F.col("ty").startswith("OBJECT"), not_object("ty"))
    return lines.withColumn("error", error).select(
        "source_file", "payload_ordinal", F.when(F.col("error").isNull(), F.col("v")).alias("payload"), "error", "began")


def field_text_expr(payload_col: str, field: str) -> Column:
    """The field's value when it is a JSON string, else NULL."""
    fv = f"variant_get({payload_col}, '$.{field}')"
    return F.expr(f"CASE WHEN schema_of_variant({fv}) = 'STRING' THEN cast({fv} AS string) END")


def payload_columns(payloads: DataFrame, fields, id_field: str = "verbatim_id",
                    payload_col: str = "payload") -> DataFrame:
    """Add one string column per PII field plus ``verbatim_id`` (as text)."""
    cols = {f: field_text_expr(payload_col, f) for f in fields}
    cols[id_field] = F.expr(f"try_variant_get({payload_col}, '$.{id_field}', 'string')")
    return payloads.withColumns(cols)


def redacted_payload_json(payload_col: str, fields, metadata_col: str = "_redaction_metadata"
                          ) -> Column:
    """JSON text of the payload with the PII fields replaced by the columns of
    the same name (only where the field was a string) and the metadata added
    when present. Unknown keys are kept (object keys come out sorted)."""
    m = f"cast({payload_col} AS map<string, variant>)"
    replaced = [(f"`{f}`", f"'{f}'") for f in fields]
    replaced.append((metadata_col, "'_redaction_metadata'"))
    drop = " AND ".join(f"NOT (k = {name} AND {c} IS NOT NULL)" for c, name in replaced)
    new = ", ".join([f"'{f}', cast(`{f}` AS variant)" for f in fields]
                    + [f"'_redaction_metadata', to_variant_object({metadata_col})"])
    expr = (f"map_concat(map_filter({m}, (k, v) -> {drop}), "
            f"map_filter(map({new}), (k, v) -> v IS NOT NULL))")
    return F.expr(f"to_json({expr})")
