"""Delimited text: all-string reads, bad-row rules, raw lines and file profiles."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Delimiters a profile considers, the defaults it falls back to, and the
# number of bad rows a load puts up with.
DELIMITERS = (",", ";", ":", "|", "\t")
QUOTES = ('"', "'")
DEFAULT_DELIMITER = ","
DEFAULT_QUOTE = '"'
MAX_BAD_ROWS = 100

BAD = "_bad_record"
STATUS = "_row_status"
OK, SURPLUS, SHORT = "ok", "surplus", "short"
# Put behind a record to see in which field it ends. A record that holds it is judged on a
# copy with another character in its place, which leaves quotes and delimiters as they are.
_END, _OTHER = "\u0002", "x"


@dataclass(frozen=True)
class Dialect:
    sep: str = "|"
    quote: str = '"'

    def __post_init__(self) -> None:
        if _END in self.sep + self.quote:
            raise ValueError("the delimiter and the quote may not hold the character U+0002")

    def options(self) -> dict[str, str]:
        return {"sep": self.sep, "quote": self.quote, "escape": self.quote}


def _fields(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _parsed(record: str, width: int, dialect: Dialect) -> Column:
    """A record parsed with an end marker behind it: its fields, and the status the
    marker's place gives. The lambda keeps it at one parse per row wherever it is used."""
    names = [f"_f{i}" for i in range(width + 1)]
    holds_end = F.contains(F.col(record), F.lit(_END))

    def parsed(text: Column) -> Column:
        return F.from_csv(F.concat(text, F.lit(dialect.sep + _END)), ", ".join(f"{n} string" for n in names),
                          {**dialect.options(), "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"})

    # Only a record that holds the mark is parsed again, for its fields as they are.
    both = F.struct(parsed(F.when(holds_end, F.translate(record, _END, _OTHER)).otherwise(F.col(record))).alias("judged"),
                    F.when(holds_end, parsed(F.col(record))).alias("own"))

    def judged(b: Column) -> Column:
        p = b["judged"]
        # An open quote swallows the delimiter, hence endswith.
        early = [F.coalesce(p[n].endswith(_END), F.lit(False)) for n in names[:-1]]
        status = (
            F.when(reduce(or_, early), F.lit(SHORT))
            .when(p[names[-1]].eqNullSafe(F.lit(_END)), F.lit(OK))
            .otherwise(F.lit(SURPLUS))
        )
        own = [F.when(b["own"].isNotNull(), b["own"][n]).otherwise(p[n]) for n in names[:-1]]
        return F.struct(status.alias("status"), *[f.alias(n) for f, n in zip(own, names)])

    return F.element_at(F.transform(F.array(both), judged), 1)


def parse_records(records: DataFrame, record: str, columns: Sequence[str],
                  dialect: Dialect = Dialect()) -> DataFrame:
    """Text records (one per row, quoted line ends inside) -> columns and a row status.

    The end marker tells short, whole and surplus records apart in the one pass that
    parses them. Surplus fields are cut off, as the loader ignores them.
    """
    kept = [c for c in records.columns if c != record]
    return records.withColumn("_p", _parsed(record, len(columns), dialect)).select(
        *kept, F.col(record).alias(BAD), F.col("_p.status").alias(STATUS),
        *[F.col(f"_p._f{i}").alias(c) for i, c in enumerate(columns)])


def read_delimited(spark: SparkSession, paths: str | list[str], columns: Sequence[str],
                   dialect: Dialect = Dialect(), header: bool = True,
                   multi_line: bool = False) -> DataFrame:
    """All-string rows with their file and a row status.

    ``multi_line`` only for files that do hold quoted line ends (see ``file_profiles``):
    Spark cannot split those. Columns are taken by position; read files with another
    header apart and unite by name.
    """
    if len(set(columns)) != len(columns):
        raise ValueError(f"column names collide: {sorted(columns)}")
    schema = _fields([*columns, BAD])
    rows = (
        spark.read.schema(schema).options(**dialect.options())
        .option("header", header).option("multiLine", multi_line).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD).option("maxCharsPerColumn", "-1")
        # With pruned columns the parser no longer sees how many fields a row has, and
        # short rows would pass as whole.
        .option("columnPruning", False)
        .csv(paths)
        .select("*", F.col("_metadata.file_path").alias("_file"))
    )
    return with_status(rows, columns, dialect)


def with_status(rows: DataFrame, columns: Sequence[str], dialect: Dialect) -> DataFrame:
    """Surplus and short rows both arrive as corrupt; the field the record ends in tells them apart."""
    # Spark refuses a CSV query that reads the corrupt record alone, so the status also
    # looks at the first column, in a way that says nothing.
    looked = F.length(F.concat_ws("", F.col(columns[0]))) >= 0
    judged = _parsed(BAD, len(columns), dialect)["status"]
    return rows.withColumn(STATUS, F.when(F.col(BAD).isNull() & looked, F.lit(OK)).otherwise(judged))


def accepted_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(STATUS) != SHORT)


def rejected_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(STATUS) == SHORT)


def files_over_limit(rows: DataFrame, by: str = "_file", limit: int = MAX_BAD_ROWS) -> DataFrame:
    """Files with more bad rows than a load puts up with."""
    return (rejected_rows(rows).groupBy(by).agg(F.count(F.lit(1)).alias("bad_rows"))
            .where(F.col("bad_rows") > limit))


def require_few_bad_rows(rows: DataFrame, by: str = "_file", limit: int = MAX_BAD_ROWS) -> None:
    worst = files_over_limit(rows, by, limit).orderBy(F.desc("bad_rows")).head(1)
    if worst:
        raise ValueError(f"{worst[0][by]}: {worst[0]['bad_rows']} bad rows, {limit} allowed")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole lines in one column, for text of no fixed width."""
    return spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line")).alias("_at"))


def read_inferred(spark: SparkSession, paths: str | list[str], dialect: Dialect = Dialect()) -> DataFrame:
    """Types inferred from the data, for files no dictionary describes. Costs a second scan."""
    return (spark.read.options(**dialect.options()).option("header", True)
            .option("inferSchema", True).csv(paths))


def opens_quote(line: Column, dialect: Dialect) -> Column:
    """Whether a line that starts outside quotes ends inside."""
    return F.contains(line, F.lit(dialect.quote)) & line.rlike("^" + _open(dialect))


def stays_quoted(line: Column, dialect: Dialect) -> Column:
    """Whether a line that starts inside quotes ends inside: it never closes the field, or
    closes it and opens another."""
    body, q, s = _parts(dialect)
    return ~F.contains(line, F.lit(dialect.quote)) | line.rlike(f"^{body}(?:{q}[^{s}]*+{s}{_open(dialect)})?$")


def _parts(dialect: Dialect) -> tuple[str, str, str]:
    q, s = re.escape(dialect.quote), re.escape(dialect.sep)
    # Possessive: a doubled quote is never taken for the end of a field.
    return f"(?:[^{q}]|{q}{q})*+", q, s


def _open(dialect: Dialect) -> str:
    body, q, s = _parts(dialect)
    return f"(?:(?:{q}{body}{q}[^{s}]*+|[^{q}{s}][^{s}]*+)?{s})*+{q}{body}$"


def file_profiles(lines: DataFrame, configured: Dialect = Dialect(), by: str = "_file") -> DataFrame:
    """Delimiter and quote each file seems to use, and whether under these it holds quoted line ends.

    One scan over whole files and one row per file and task in the shuffle. A delimiter
    wins by being in the file's first line, where that is known, then by the share of lines
    that hold it, then by how even its count per line is.
    Where nothing is found the defaults apply; with an unusual configured quote nothing
    is sniffed. The dialect columns are null where they equal the configured values. Lines
    that know their place (see ``read_lines``) also give each file's first line.
    """
    placed = "_at" in lines.columns
    candidates = [*DELIMITERS, *([configured.sep] if configured.sep not in DELIMITERS else [])]
    sniffed = configured.quote in QUOTES
    # Quoted line ends are judged for every dialect that may win, in the same scan.
    dialects = [Dialect(d, q) for d in candidates for q in QUOTES] if sniffed else [configured]
    plain = F.regexp_replace("value", '"[^"]*"', "")
    counted = lines.select(
        by,
        *[F.regexp_count(plain, F.lit(_literal(d))).alias(f"_d{i}") for i, d in enumerate(candidates)],
        *[F.regexp_count("value", F.lit(f"(?:^|[{_class(candidates)}]){q}")).alias(f"_q{i}")
          for i, q in enumerate(QUOTES)],
        *[opens_quote(F.col("value"), d).alias(f"_open{i}") for i, d in enumerate(dialects)],
        *([F.when(F.col("_at.split") == 0, F.struct("_at", "value")).alias("_line")] if placed else []),
    )
    stats = counted.groupBy(by).agg(
        F.count(F.lit(1)).alias("lines"),
        *[F.struct(
            F.count(F.when(F.col(f"_d{i}") > 0, 1)).alias("hit_lines"),
            (-F.coalesce(F.try_divide(F.stddev_pop(f"_d{i}"), F.avg(f"_d{i}")), F.lit(0.0))).alias("even"),
            F.sum(f"_d{i}").alias("hits"), F.lit(d).alias("delimiter"),
        ).alias(f"_s{i}") for i, d in enumerate(candidates)],
        *[F.struct(F.sum(f"_q{i}").alias("hits"), F.lit(q).alias("quote")).alias(f"_t{i}")
          for i, q in enumerate(QUOTES)],
        *[F.max(f"_open{i}").alias(f"_open{i}") for i in range(len(dialects))],
        *([F.min("_line").alias("_line")] if placed else []),
    )
    # The header holds the delimiter, if it holds any: prose behind it may hold others more often.
    in_header = [F.coalesce(F.contains(F.col("_line.value"), F.lit(d)), F.lit(False)) if placed else F.lit(False) for d in candidates]
    best = F.greatest(*[F.struct(h.alias("in_header"), *[F.col(f"_s{i}.{f}") for f in ("hit_lines", "even", "hits", "delimiter")])
                        for i, h in enumerate(in_header)])
    mark = F.greatest(*[F.col(f"_t{i}") for i in range(len(QUOTES))])
    delimiter = F.when(best["hits"] > 0, best["delimiter"]).otherwise(F.lit(DEFAULT_DELIMITER))
    quote = F.when(mark["hits"] > 0, mark["quote"]).otherwise(F.lit(DEFAULT_QUOTE))
    if not sniffed:
        delimiter, quote = F.lit(configured.sep), F.lit(configured.quote)
    quoted = F.coalesce(*[F.when((delimiter == d.sep) & (quote == d.quote), F.col(f"_open{i}")) for i, d in enumerate(dialects)])
    return stats.select(
        by, "lines", quoted.alias("quoted_line_ends"),
        delimiter.alias("field_delimiter"), quote.alias("quote_delimiter"),
        F.nullif(delimiter, F.lit(configured.sep)).alias("dialect_field_delimiter"),
        F.nullif(quote, F.lit(configured.quote)).alias("dialect_quote_delimiter"),
        *([F.col("_line.value").alias("first_line")] if placed else []),
    )


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def _class(chars: Sequence[str]) -> str:
    return "".join("\\" + c if c in "|^]-[\\" else c for c in chars)
