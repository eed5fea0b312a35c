"""Checks of an upload manifest: kind, extension, date, file presence and columns.

A manifest has one row per upload: ``path``, ``data_type``, ``patient_id``,
``registry_date``, ``consent_raw_storage``, ``source``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit import domain
from cohortkit.operators.quality import date_error
from cohortkit.session import broadcast_if_small, materialise


def extension(path: Column | str) -> Column:
    """Lower-case extension with its dot; empty if there is none."""
    text = F.col(path) if isinstance(path, str) else path
    return F.lower(F.regexp_extract(text, r"[^/.](\.[^./]*)$", 1))


def format_error(path: Column, data_type: Column, accepted: Mapping[str, Sequence[str]] = domain.ACCEPTED_EXTENSIONS) -> Column:
    """Message for an unknown kind, or for an extension that its kind does not take."""
    allowed = F.create_map(*[
        part for kind, exts in accepted.items() for part in (F.lit(kind), F.array(*[F.lit(e) for e in exts]))
    ])
    fits = F.array_contains(allowed[data_type], extension(path))
    return (
        F.when(data_type.isNull() | ~data_type.isin(*accepted), "invalid data type")
        .when(~F.coalesce(fits, F.lit(False)), "unsupported file format")
    )


def plain_path(path: Column) -> Column:
    """A local path without its scheme, as manifests write it."""
    return F.regexp_replace(path, "^file:(//)?(?=/)", "")


def file_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Path and length of every file below a folder; contents are not read.

    Spark's file scan leaves empty files out, so an empty file looks like a missing one.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return listing.select(plain_path(F.col("path")).alias("path"), "length")


# Commas outside quotes, and the quotes around a name.
_BETWEEN_NAMES = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def header_names(line: Column) -> Column:
    """The column names of a CSV header line: quotes, doubled quotes, blanks around names and a byte order mark are undone."""
    plain = F.regexp_replace(line, "^\ufeff|\r$", "")
    bare = lambda name: F.regexp_replace(F.regexp_replace(F.trim(name), '^"(.*)"$', "$1"), '""', '"')
    return F.transform(F.split(plain, _BETWEEN_NAMES, -1), bare)


def file_contents(spark: SparkSession, folder: str, paths: DataFrame | None = None) -> DataFrame:
    """Column names and number of data rows per CSV and JSON file below a folder: ``path``, ``header``, ``n_rows``.

    Extensions count in any case. A JSON file holds an array of records, or one; one that
    holds none has no names and no rows. A line feed inside a quoted CSV field counts as a row.
    With ``paths`` (path) only those files are looked at.
    """
    listed = None if paths is None else broadcast_if_small(paths.select("path").distinct())

    def wanted(found: DataFrame) -> DataFrame:
        return found if listed is None else found.join(listed, "path", "left_semi")

    return _csv_contents(spark, folder, wanted).unionByName(_json_contents(spark, folder, wanted))


# Blanks of JSON, and what opens, closes and separates its values, escapes included.
_BLANK = r"[ \t\r\n]*"
_STRUCTURE = re.compile(r"\\.|[\"'{}\[\],]", re.DOTALL)


def _json_fragments(spark: SparkSession, folder: str, wanted: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """JSON files cut behind each closing brace, which is left out: path, size of the file, place (start, line), value."""
    return wanted(
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.[jJ][sS][oO][nN]").option("lineSep", "}").text(folder)
        .select(
            plain_path(F.col("_metadata.file_path")).alias("path"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        )
    )


def _elements(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The records of files whose fragments come in order: path, place, text; a null text says that the file is none.

    Only the record being put together is held.
    """
    path, ended = None, True
    for frame in frames:
        out = []
        for name, value, closed in zip(frame["path"], frame["value"], frame["closed"], strict=True):
            if name != path:
                if not ended:
                    out.append((path, at, None))
                path, ended, at, depth, quote, root, text, opened = name, False, 0, 0, None, None, [], 0
            if ended:
                continue
            piece, begin = value + "}" if closed else value, 0
            if root is None:
                bare = piece.lstrip(" \t\r\n")
                if not bare:
                    continue
                root, ended = bare[0], bare[0] not in "[{"
                begin = len(piece) - len(bare) + (root == "[")
                depth = int(root == "[")
            for found in [] if ended else _STRUCTURE.finditer(piece, begin):
                mark = found.group()
                if quote:
                    quote = None if mark == quote else quote
                elif mark in "\"'":
                    quote = mark
                elif mark in "{[":
                    opened += depth == 1
                    depth += 1
                elif mark in "}]":
                    depth -= 1
                if quote or mark not in ",]}" or depth > 1 or (depth == 1 and root == "{"):
                    continue
                if root == "[" and depth == 1 and mark != ",":
                    continue
                end = depth == 0
                text.append(piece[begin : found.end() if root == "{" else found.start()])
                record, begin, text = "".join(text).strip(" \t\r\n"), found.end(), []
                empty = end and at == 0 and root == "[" and not record
                whole = record == "null" or record[:1] == "{" and record[-1] == "}" and (root == "{" or opened == 1)
                if not (empty or whole) or end and mark != {"[": "]", "{": "}"}[root]:
                    out.append((path, at, None))
                    ended = True
                    break
                if record not in ("", "null"):
                    out.append((path, at, record))
                opened = 0
                at += 1
                if end:
                    ended = True
                    break
            if not ended:
                text.append(piece[begin:])
        yield pd.DataFrame(out, columns=["path", "at", "record"])
    if not ended:
        yield pd.DataFrame([(path, at, None)], columns=["path", "at", "record"])


def _json_contents(spark: SparkSession, folder: str, wanted: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Header and rows of JSON files.

    A file is plain if it is an array of records without a brace inside: then each fragment is a record, wherever it is
    read. The fragments of other files are put together in order, a file by one task, which holds one record.
    """
    pieces = _json_fragments(spark, folder, wanted)
    value = F.col("value")
    kind = F.when(value.rlike(rf"^{_BLANK}\[{_BLANK}\{{"), "open").when(value.rlike(rf"^{_BLANK},{_BLANK}\{{"), "next").when(
        value.rlike(rf"^{_BLANK}\]"), "close").otherwise("other")
    record = F.concat(F.regexp_extract("value", rf"(?s)^{_BLANK}[\[,]{_BLANK}(\{{.*)$", 1), F.lit("}"))
    names = lambda text: F.map_keys(F.from_json(text, "map<string,string>"))
    counted = materialise(
        pieces.withColumn("kind", kind)
        .withColumn("names", F.when(F.col("kind").isin("open", "next"), names(record)))
        .groupBy("path", "start", "kind", "names")
        .agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("first"), F.max("line").alias("last"), F.max("size").alias("size"),
             F.sum(F.octet_length("value") + 1).alias("bytes")),
        "json-fragments",
    )
    of = lambda *kinds: F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds) & (F.col("names").isNotNull() | (F.col("kind") == "close")), F.col("n"))), F.lit(0))
    files = counted.groupBy("path").agg(
        ((F.min_by("kind", F.struct("start", "first")) == "open") & (F.max_by("kind", F.struct("start", "last")) == "close")
         & (of("open") == 1) & (of("close") == 1) & (of("open", "next", "close") == F.sum("n"))).alias("plain"),
        # One less than the bytes read if no brace ends the file; a byte order mark is not read.
        F.max_by(F.struct("start", "last"), F.struct("start", "last")).alias("end"),
        (F.sum("bytes").isin(F.max("size"), F.max("size") - 3)).alias("braced"),
    )
    files = broadcast_if_small(files)
    plain = counted.where("names is not null").join(files.where("plain").select("path"), "path", "left_semi").select("path", "start", "first", "names", "n")
    others = files.where("not plain")
    if not others.isEmpty():
        ordered = pieces.join(others, "path").withColumn("closed", F.col("braced") | (F.struct("start", "line") < F.col("end"))).select(
            "path", "start", "line", "value", "closed").repartition("path").sortWithinPartitions("path", "start", "line")
        records = ordered.drop("start", "line").mapInPandas(_elements, "path string, at long, record string")
        rest = records.withColumn("names", names(F.col("record"))).groupBy("path", "names").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
        rest = materialise(rest, "json-records")
        broken = rest.where("names is null").select("path").distinct()
        rest = rest.join(broken, "path", "left_anti")
        plain = plain.unionByName(rest.select("path", F.lit(0).cast("bigint").alias("start"), "first", "names", "n"))
    sizes = plain.groupBy("path").agg(F.sum("n").alias("n_rows"))
    places = plain.select("path", "start", "first", F.posexplode("names").alias("at", "name")).groupBy("path", "name").agg(
        F.min(F.struct("start", "first", "at")).alias("at"))
    headers = places.groupBy("path").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]).alias("header"))
    return files.select("path").join(sizes, "path", "left").join(headers, "path", "left").select(
        "path", F.coalesce("header", F.array().cast("array<string>")).alias("header"), F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"))


def _csv_contents(spark: SparkSession, folder: str, wanted: Callable[[DataFrame], DataFrame]) -> DataFrame:
    lines = wanted(
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.[cC][sS][vV]").text(folder)
        .select(
            plain_path(F.col("_metadata.file_path")).alias("path"),
            F.col("_metadata.file_block_start").alias("_start"),
            "value",
            F.monotonically_increasing_id().alias("_line"),
        )
    )
    # Line ids rise within a file block; the header is the first line of the first block.
    first = F.min_by("value", F.struct("_start", "_line"))
    return lines.groupBy("path").agg(
        header_names(first).alias("header"),
        (F.count(F.when(F.trim("value") != "", 1)) - 1).alias("n_rows"),
    )


def validate_manifest(
    manifest: DataFrame,
    sizes: DataFrame | None = None,
    contents: DataFrame | None = None,
    required: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Add ``errors``, the list of everything wrong with each upload; an empty list is valid.

    ``sizes`` (path, length) adds the presence checks, ``contents`` (path, header,
    n_rows) the checks of tabular files against the required columns.
    """
    required = required or {
        "phenotypic": list(domain.RAW_PHENOTYPE_TYPES),
        "genotypic": [domain.KEY, *domain.SNPS],
    }
    checked = manifest
    errors = [
        format_error(F.col("path"), F.col("data_type")),
        date_error(F.col("registry_date")),
    ]
    if sizes is not None:
        checked = checked.join(sizes.select("path", F.col("length").alias("_length")), "path", "left")
        errors.append(F.when(F.coalesce(F.col("_length"), F.lit(0)) == 0, "file is missing or empty"))
    if contents is not None:
        checked = checked.join(
            contents.select("path", F.col("header").alias("_header"), F.col("n_rows").alias("_n_rows")), "path", "left"
        )
        wanted = F.create_map(*[
            part for kind, names in required.items() for part in (F.lit(kind), F.array(*[F.lit(n) for n in names]))
        ])
        missing = F.array_except(wanted[F.col("data_type")], F.col("_header"))
        errors += [
            F.when(F.col("_n_rows") <= 0, "tabular file has no rows"),
            F.when(F.size(missing) > 0, F.concat(F.lit("missing columns: "), F.array_join(missing, ", "))),
        ]
    return checked.withColumn("errors", F.array_compact(F.array(*errors))).select(
        *[f"`{c}`" for c in manifest.columns], "errors"
    )


def valid_uploads(validated: DataFrame) -> DataFrame:
    """Uploads without errors."""
    return validated.where(F.size("errors") == 0).drop("errors")
