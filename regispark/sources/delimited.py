"""Delimited bulk scan of header-less registry files.

Default path, splittable: text lines as bytes, then decode, NUL removal and CSV parsing as native
expressions of one stage, so a large file is read by as many tasks as it has splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regispark.functions.codepage import controls_to_cp1252, latin1, strip_nul
from regispark.schemas import Table
from regispark.sources.files import is_leftover
from regispark.sources.multiline import read_lines, records

# The file format.
FORMAT = {"sep": ";", "quote": '"', "escape": '"', "header": "false"}
BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# Tells an empty field, NULL, from a quoted empty string; no cleaned line holds this character.
PARSE = FORMAT | BLANKS | {"nullValue": "\x00"}

# Tokens a dataframe reader takes for missing by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

CORRUPT = "_corrupt"
FILE = "_file"
ENCODINGS = ("cp1252", "latin-1")


def scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    names: Sequence[str],
    *,
    encoding: str = "cp1252",
    on_error: str = "fail",
    na_tokens: Sequence[str] = (),
    glob: str | None = None,
    multiline: bool = False,
    file_column: bool = False,
) -> DataFrame:
    """All-text staging rows of one or more files, folders or patterns (a UNION ALL of files).

    ``on_error="fail"`` stops the job at a row with the wrong number of fields; ``"quarantine"``
    keeps such rows with the raw line in ``_corrupt`` (see ``split_corrupt``).
    Blank lines are skipped, and files that a load left behind (``files.is_leftover``). ``multiline`` allows line breaks inside quotes, at the price of reading
    the files twice, the first time at once (see ``multiline.records``).
    """
    if multiline:
        lines = read_lines(spark, paths, glob)
        whole = records(lines, recoded(latin1(F.col("value")), encoding), file=FILE, on_error=on_error)
        rows = parse_records(whole, names, on_error=on_error, keep=[FILE])
    else:
        reader = spark.read.option("lineSep", "\n")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        rows = reader.text(paths if isinstance(paths, str) else list(paths))
        rows = parse_lines(
            rows.withColumn(FILE, F.col("_metadata.file_name")),
            names,
            encoding=encoding,
            on_error=on_error,
            keep=[FILE],
        )
    rows = rows.where(~is_leftover(F.col(FILE)))
    rows = without_missing(rows, names, na_tokens)
    return rows if file_column else rows.drop(FILE)


def parse_lines(
    lines: DataFrame,
    names: Sequence[str],
    *,
    line: str = "value",
    encoding: str = "cp1252",
    on_error: str = "fail",
    keep: Sequence[str] = (),
    decoded: bool = False,
) -> DataFrame:
    """Rows of text from raw lines, or from lines already ``decoded`` as ISO-8859-1.

    ``inline`` keeps the parser at one call per line.
    """
    text = F.col(line) if decoded else latin1(F.col(line))
    clean = clean_line(text, encoding)
    lines = lines.where(F.ltrim(F.col(line), F.lit(" \r\x00")) != "")
    parsed = F.inline(F.array(_from_csv(clean, names, on_error)))
    return lines.select(*keep, parsed)


def parse_records(
    whole: DataFrame, names: Sequence[str], *, on_error: str = "fail", keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of text from cleaned records (``value``), which may hold line breaks. A record that is not
    ``whole`` is a corrupt row."""
    text = _without_cr(F.col("value"))
    lines = whole.where(F.ltrim(F.col("value"), F.lit(" \r")) != "")
    if on_error == "fail":
        return lines.select(*keep, F.inline(F.array(_from_csv(text, names, on_error))))
    parsed = lines.where("whole").select(*keep, F.inline(F.array(_from_csv(text, names, on_error))))
    nothing = [F.lit(None).cast("string").alias(name) for name in names]
    return parsed.unionByName(lines.where("not whole").select(*keep, *nothing, F.col("value").alias(CORRUPT)))


def clean_line(latin1_line: Column, encoding: str = "cp1252") -> Column:
    """Line in its real encoding, without NULs and without the CR of a CRLF ending."""
    return _without_cr(recoded(latin1_line, encoding))


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quarantine scan into good rows and raw lines with the wrong number of fields."""
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    kept = [c for c in rows.columns if c == FILE]
    return good, rows.where(F.col(CORRUPT).isNotNull()).select(*kept, CORRUPT)


def missing_to_null(c: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    return F.when(~c.isin(list(tokens)), c)


def without_missing(rows: DataFrame, names: Sequence[str], tokens: Sequence[str]) -> DataFrame:
    """NULL for the given tokens in all named columns; without tokens nothing changes."""
    if not tokens:
        return rows
    return rows.withColumns({c: missing_to_null(F.col(c), tokens) for c in names})


def scan_table(spark: SparkSession, folder: str, table: Table, **options) -> DataFrame:
    """Staging rows of every file in a folder whose name holds the table's token."""
    return scan(spark, folder, table.names, glob=f"*{table.token}*", **options)


def recoded(latin1_text: Column, encoding: str) -> Column:
    """Text in its real encoding, without NULs."""
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding must be one of {ENCODINGS}")
    return strip_nul(controls_to_cp1252(latin1_text) if encoding == "cp1252" else latin1_text)


def _without_cr(c: Column) -> Column:
    return F.when(c.endswith("\r"), c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)


def _from_csv(line: Column, names: Sequence[str], on_error: str) -> Column:
    columns = [f"`{name}` string" for name in names]
    options = dict(PARSE)
    if on_error == "fail":
        options["mode"] = "FAILFAST"
    else:
        columns.append(f"`{CORRUPT}` string")
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_csv(line, ", ".join(columns), options)
