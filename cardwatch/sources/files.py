"""The three daily files (SRC-4, SRC-5, SRC-7) and the bank tables (SRC-1).

* transactions: ``;``-separated text with a header row, decimal comma and
  ``yyyy-MM-dd HH:mm:ss`` times; columns bound by position.
* terminals / passport blacklist: XLSX workbooks, see :mod:`cardwatch.sources.xlsx`.
* bank tables: any JDBC source, options supplied by the caller.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch import schemas as S

# Daily file name patterns (date as ddMMyyyy).
FILE_PATTERNS = {
    "transactions": "transactions_{date}.txt",
    "terminals": "terminals_{date}.xlsx",
    "blacklist": "passport_blacklist_{date}.xlsx",
}

TX_FILE_SCHEMA = T.StructType([
    T.StructField("trans_id", T.StringType()),
    T.StructField("transaction_date", T.TimestampNTZType()),
    T.StructField("amount", T.DecimalType(10, 2)),
    T.StructField("card_num", T.StringType()),
    T.StructField("oper_type", T.StringType()),
    T.StructField("oper_result", T.StringType()),
    T.StructField("terminal", T.StringType()),
])
CORRUPT = "_corrupt_record"


def daily_path(folder: str, kind: str, business_date: dt.date | str) -> str:
    """SRC-5: the file of ``kind`` for one business date."""
    if isinstance(business_date, str):
        business_date = dt.date.fromisoformat(business_date)
    return f"{folder.rstrip('/')}/" + FILE_PATTERNS[kind].format(date=business_date.strftime("%d%m%Y"))


def date_of(kind: str, name: str) -> dt.date | None:
    """The business date in a file name of ``kind``; None if the name is not of that pattern."""
    head, tail = FILE_PATTERNS[kind].split("{date}")
    digits = name[len(head):len(name) - len(tail)]
    if not (name.startswith(head) and name.endswith(tail) and len(digits) == 8 and digits.isdigit()):
        return None
    try:
        return dt.datetime.strptime(digits, "%d%m%Y").date()
    except ValueError:
        return None


def blank_to_null(c: str):
    """Empty text is NULL in the warehouse."""
    return F.when(F.col(c) == "", F.lit(None)).otherwise(F.col(c))


#: How a line is read: by position, decimal comma (1234,5 -> 1234.50), zone-free times.
LINE_OPTIONS = {"sep": ";", "locale": "de-DE", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
                "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def transaction_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every line below the header, with its columns and, in ``reason``, why it is rejected (NULL: it is not).

    The file is read as whole lines and each is parsed once, all columns of it, in a
    generator that no projection reaches into: ``select`` and ``count`` see the same rows as a full read.
    Reasons: ``columns`` (more or fewer than the schema has), ``transaction_date``, ``amount``.
    """
    lines = (spark.read.schema("line string").option("header", True).option("enforceSchema", True)
             .option("sep", "\u0001").option("quote", "").option("escape", "").csv(paths))
    fields = T.StructType([*TX_FILE_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parsed = lines.select("line", F.inline(F.array(F.from_csv("line", ddl, LINE_OPTIONS))))
    bad = F.col(CORRUPT).isNotNull()
    return parsed.withColumn("reason", F.when(bad & F.col("transaction_date").isNull() & F.col("amount").isNull() & F.col("terminal").isNull(), "columns")
                             .when(bad & (F.size(F.split("line", ";")) > len(TX_FILE_SCHEMA)), "columns")
                             .when(bad & F.col("transaction_date").isNull(), "transaction_date")
                             .when(bad & F.col("amount").isNull(), "amount").when(bad, "columns"))


def staging_columns() -> list:
    """File columns -> staging schema; blank text -> NULL, padded card numbers trimmed."""
    return [
        blank_to_null("trans_id").alias("trans_id"),
        F.col("transaction_date").alias("trans_date"),
        F.col("amount").alias("amt"),
        F.rtrim(blank_to_null("card_num")).alias("card_num"),
        blank_to_null("oper_type").alias("oper_type"),
        blank_to_null("oper_result").alias("oper_result"),
        blank_to_null("terminal").alias("terminal")]


def conform_transactions(raw: DataFrame) -> DataFrame:
    return raw.select(*staging_columns())


def read_transactions(spark: SparkSession, path: str | list[str], bad_rows: str = "fail"):
    """SRC-4 / SRC-7: the day's operations.

    ``bad_rows="fail"`` stops on the first malformed row (as the daily job
    does); ``"quarantine"`` returns ``(good, bad)``, ``bad`` with the raw text of the malformed rows, the
    reason of each and the columns that could be read. A row is malformed
    whatever columns the query goes on to use, in both modes.
    """
    lines = transaction_lines(spark, [path] if isinstance(path, str) else path)
    if bad_rows == "fail":
        stop = F.raise_error(F.concat(F.lit("MALFORMED_ROW ("), F.col("reason"), F.lit("): "), F.col("line"))).cast("boolean")
        return conform_transactions(lines.where(F.when(F.col("reason").isNull(), True).otherwise(stop)))
    if bad_rows != "quarantine":
        raise ValueError(f"bad_rows is fail or quarantine, not {bad_rows!r}")
    bad = lines.where(F.col("reason").isNotNull()).select(
        F.col("line").alias("raw_line"), "reason", F.struct(*TX_FILE_SCHEMA.fieldNames()).alias("parsed"))
    return conform_transactions(lines.where(F.col("reason").isNull())), bad


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None, fetch_size: int = 10000, **extra) -> dict:
    """SRC-1: options for ``spark.read.format("jdbc")`` (credentials come from the caller)."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partition column needs lower/upper bounds and a partition count")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


BANK_SCHEMAS = {"clients": S.SRC_CLIENTS, "accounts": S.SRC_ACCOUNTS, "cards": S.SRC_CARDS}


def conform_bank(df: DataFrame, table: str) -> DataFrame:
    """A bank table in its schema: text right-trimmed (``CHAR(n)`` columns arrive
    padded, the day's files do not), blank text NULL."""
    df = S.conform(df, BANK_SCHEMAS[table])
    return df.select(*[F.when(F.rtrim(f.name) != "", F.rtrim(f.name)).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema])


def read_bank(spark: SparkSession, table: str, options: dict) -> DataFrame:
    """SRC-1: one operational table; the change-capture filter is pushed to the database."""
    return conform_bank(spark.read.format("jdbc").options(**options).load(), table)
