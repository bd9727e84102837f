"""Scans of the contract, cancellation, claim and audit feeds.

JSON documents are read as VARIANT: their fields vary in type and spelling, and a value of the
wrong shape costs only itself. Only the listed paths are taken out, so customer data never gets
past the scan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactlens.functions.calendar import sql_date
from pactlens.functions.scalars import lenient_date, lenient_number, lenient_timestamp, unwrapped
from pactlens.sources import schemas as S


def drop_pii(df: DataFrame) -> DataFrame:
    """Remove customer fields at the top level and inside ``metadata``."""
    df = df.drop(*S.PII_FIELDS)
    if "metadata" in df.columns and isinstance(df.schema["metadata"].dataType, T.StructType):
        held = set(df.schema["metadata"].dataType.names) & set(S.PII_FIELDS)
        if held:
            df = df.withColumn("metadata", F.col("metadata").dropFields(*[f"`{n}`" for n in held]))
    return df


_STRING = "'string'"


def _read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("singleVariantColumn", "doc").json(path)


def _string_at(*paths: str) -> str:
    """Text at the first of several paths that holds any (SQL text)."""
    quoted = ["'" + p.replace("'", "\\'") + "'" for p in paths]
    return f"coalesce({', '.join(f'try_variant_get(doc, {p}, {_STRING})' for p in quoted)})"


def _unwrapped_strings(docs: DataFrame, strings: dict[str, str], others: list[str]) -> DataFrame:
    """``strings`` with extended JSON taken off, and the arrival number. They are taken out of the document first,
    once each: unwrapping looks at a text several times. Files that arrive over time have no common order."""
    place = "0L" if docs.isStreaming else "monotonically_increasing_id()"
    found = docs.selectExpr(
        *[f"{e} AS {n}" for n, e in strings.items()], *others,
        "try_variant_get(doc, '$.ingest_ord', 'bigint') AS own_place",
    )
    # a place in the files is no fixed value, so no filter above is put below this step, with all its texts repeated
    return found.selectExpr(
        *[f"{unwrapped(n)} AS {n}" for n in strings],
        *[c for c in found.columns if c not in strings],
        f"coalesce(own_place, {place}) AS ingest_ord",
    )


_ID = {"id_oid": _string_at("$._id['$oid']"), "id_text": _string_at("$._id")}


def _amounts(path: str) -> str:
    """``map<category, map<component, text>>``; a category that is no object becomes empty (SQL text)."""
    return f"try_variant_get(doc, '{path}', 'map<string,map<string,string>>')"


def _plain_amounts(found: str) -> str:
    """Amounts with extended JSON taken off and no category missing (SQL text)."""
    return (
        f"transform_values({found}, (c, v) ->"
        f" transform_values(coalesce(v, map()), (n, a) -> {unwrapped('a')}))"
    )


_CURVE = "$.CalculatedFields.EarningCurve.schedule"


def _earning_curve() -> str:
    """Factors by month of any spelling (SQL text); lambdas are not compiled, so this is dear."""
    raw = f"try_variant_get(doc, '{_CURVE}', 'map<string,variant>')"
    factor = unwrapped("try_variant_get(v, '$.cumulativeFactor', 'string')")
    return (
        f"transform_values(transform_keys(map_filter({raw},"
        " (k, v) -> try_cast(k AS int) IS NOT NULL), (k, v) -> cast(k AS int)),"
        f" (k, v) -> {lenient_number(factor, 'double')})"
    )


def _with_curve(docs: DataFrame) -> DataFrame:
    """The document with its earning curve. One whose months and factors are all plain numbers, as nearly all
    are, is read by casts of whole arrays; an array with a NULL has a month or factor of another spelling."""
    held = f"try_variant_get(doc, '{_CURVE}', 'map<string,struct<cumulativeFactor:string>>')"
    return (
        docs.selectExpr("doc", f"{held} AS _held")
        .selectExpr(
            "doc",
            "try_cast(map_keys(_held) AS array<int>) AS _months",
            "try_cast(map_values(_held).cumulativeFactor AS array<double>) AS _factors",
        )
        .selectExpr(
            "doc",
            "CASE WHEN array_contains(_months, -1) IS NOT NULL AND array_contains(_factors, -1D) IS NOT NULL"
            f" THEN map_from_arrays(_months, _factors) ELSE {_earning_curve()} END AS earning_curve",
        )
    )


def contract_fields(docs: DataFrame, feed: int) -> DataFrame:
    """Fields of contract (0) or cancellation (1) documents held as VARIANT in ``doc``."""
    dates = {f"date_{i}": _string_at(p) for i, p in enumerate(S.CONTRACT_DATE_PATHS)}
    found = _unwrapped_strings(
        _with_curve(docs),
        {**_ID, **{n: _string_at(*paths) for n, paths in S.CONTRACT_PATHS.items()}, **dates},
        [
            f"{_amounts('$.WrittenAmount')} AS written", f"{_amounts('$.CancelledAmount')} AS cancelled",
            "earning_curve",
        ],
    )
    return found.selectExpr(
        f"{feed} AS feed",
        "coalesce(id_oid, id_text) AS source_id",
        "ingest_ord",
        *S.CONTRACT_PATHS,
        f"array({', '.join(dates)}) AS extraction",
        f"{_plain_amounts('written')} AS written",
        f"{_plain_amounts('cancelled')} AS cancelled",
        "earning_curve",
    )


def read_contracts(spark: SparkSession, path: str, activated_from: date | None = None) -> DataFrame:
    """Contract documents, all of them unless a lower bound on the activation date is given."""
    df = contract_fields(_read_documents(spark, path), 0)
    if activated_from is not None:
        df = df.where(f"{lenient_date('activation')} >= {sql_date(activated_from)}")
    return df


def read_contract_store(
    spark: SparkSession, path: str, schema: T.StructType, activated_from: date | None = None
) -> DataFrame:
    """Documents of ``write_contract_store``: all, or all cancellations and the contracts activated from a day on.

    ``schema`` is that of the documents. Folders of earlier months are not opened.
    """
    stored = T.StructType([*schema.fields, T.StructField("activation_day", T.DateType()), T.StructField("activation_month", T.DateType())])
    df = spark.read.schema(stored).parquet(path)
    if activated_from is not None:
        first = sql_date(activated_from)
        df = df.where(f"feed = 1 OR (activation_month >= trunc({first}, 'MM') AND activation_day >= {first})")
    return df.select(*schema.names)


def read_cancellations(spark: SparkSession, path: str) -> DataFrame:
    return contract_fields(_read_documents(spark, path), 1)


def read_contract_feeds(spark: SparkSession, contracts: str, cancellations: str) -> DataFrame:
    return read_contracts(spark, contracts).unionByName(read_cancellations(spark, cancellations))


def read_claims(spark: SparkSession, path: str) -> DataFrame:
    return claim_fields(_read_documents(spark, path))


def claim_fields(docs: DataFrame) -> DataFrame:
    """Fields of claim documents held as VARIANT in ``doc``."""
    dates = {f"date_{i}": _string_at(p) for i, p in enumerate(S.CLAIM_DATE_PATHS)}
    found = _unwrapped_strings(
        docs,
        {**_ID, **{n: _string_at(*paths) for n, paths in S.CLAIM_PATHS.items()}, **dates},
        [],
    )
    return found.selectExpr(
        "coalesce(id_oid, id_text) AS source_id",
        "ingest_ord",
        *S.CLAIM_PATHS,
        f"array({', '.join(dates)}) AS extraction",
    )


def read_pricing(spark: SparkSession, path: str) -> DataFrame:
    """Contract documents with the fields the pricing reports need."""
    docs = _read_documents(spark, path)
    strings = {n: _string_at(p) for n, p in S.PRICING_PATHS.items()}
    return _unwrapped_strings(docs, strings, []).select("ingest_ord", *S.PRICING_PATHS)


def read_audits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.AUDIT).json(path)


def _count(value: str) -> str:
    """Whole number written with thousands commas or as an extended-JSON integer; 0 if none."""
    bare = f"translate(coalesce(get_json_object({value}, '$.$numberInt'), {value}), ',', '')"
    return f"coalesce(cast(try_cast({bare} AS double) AS bigint), 0L)"


def latest_audits(audits: DataFrame) -> DataFrame:
    """Newest audit record of each job type, normalised and flattened."""
    fields = [c for c in audits.columns if c != "jobType"]
    executed = lenient_timestamp(f"({unwrapped('executionTimestamp')})")
    newest = (
        audits.where("jobType IN ('Contract', 'Cancel', 'Claim')")
        .groupBy("jobType")
        .agg(F.expr(f"max_by(struct({', '.join(fields)}), struct({executed}, _id)) AS a"))
        .select("jobType", "a.*")
    )
    return newest.selectExpr(
        "jobType AS job_type",
        f"coalesce({executed}, current_timestamp()) AS execution_timestamp",
        "coalesce(executionDateStr, '') AS execution_date_text",
        "coalesce(dateRange.startDate, '') AS start_date",
        "coalesce(dateRange.endDate, '') AS end_date",
        f"{_count('counts.portalCount')} AS portal_count",
        f"CASE WHEN counts.uniqueCount IS NOT NULL THEN {_count('counts.uniqueCount')} END"
        " AS unique_count",
        f"{_count('counts.processedCount')} AS processed_count",
        f"{_count('counts.uploadedCount')} AS uploaded_count",
        "coalesce(reconciliation.isMatch, false) AS is_match",
        f"{_count('reconciliation.portalVsProcessedDiff')} AS portal_vs_processed_diff",
        f"{_count('reconciliation.processedVsUploadedDiff')} AS processed_vs_uploaded_diff",
        "coalesce(reconciliation.status, 'UNKNOWN') AS status",
        "coalesce(reconciliation.summary, '') AS summary",
        "coalesce(fileMetadata.fileName, '') AS file_name",
    )


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Delimited export with a header line; dotted column names need back quotes."""
    return spark.read.option("header", True).schema(schema).csv(path)


def query(spark: SparkSession, statement: str, tables: dict[str, DataFrame] | None = None, **params):
    """Parameterised SQL over named frames."""
    for name, frame in (tables or {}).items():
        frame.createOrReplaceTempView(name)
    return spark.sql(statement, args=params or None)
