"""Text, CSV, JSON and image-header sources, and the sinks that mirror them."""

from __future__ import annotations

import re
import struct
import tempfile
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Line ends in the sense of Unicode text: CR LF as one, then each single mark.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
#: A part file of at most this many bytes has no rows.
EMPTY_BYTES = 50


def work_folder(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share.

    A folder of our own is set only where the session names none and runs in this
    process alone, as in tests; a cluster without one is an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="linefold-"))
    return f"{sc.getCheckpointDir()}/files-{uuid.uuid4().hex}"


def nfc(column):
    """Canonical composition; the engine has no built-in, so Arrow batches are used."""
    @F.pandas_udf("string")
    def compose(texts: pd.Series) -> pd.Series:
        return texts.str.normalize("NFC")

    return compose(column)


def char_names(chars: DataFrame, column: str = "ch") -> DataFrame:
    """``chars`` with the Unicode name and category of a character ("" if it has no name)
    and whether it is punctuation: by category, a danda, or an ASCII sign."""
    ascii_signs = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

    @F.pandas_udf("name string, category string, punctuation boolean")
    def named(x: pd.Series) -> pd.DataFrame:
        category = x.map(unicodedata.category)
        return pd.DataFrame({"name": x.map(lambda c: unicodedata.name(c, "")), "category": category, "punctuation": category.str.startswith("P") | x.isin(ascii_signs | {"।", "॥"})})

    return chars.withColumn("_n", named(F.col(column))).select("*", "_n.*").drop("_n")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, line_no from 0, line) of whole files, composed and split at every
    Unicode line end; one empty piece after a last line end is no line."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), nfc(F.col("value")).alias("value"))
    pieces = F.split(F.regexp_replace("value", f"({LINE_END})$", ""), LINE_END)
    return whole.where("value <> ''").select("file", F.posexplode(pieces).alias("line_no", "line"))


def csv_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with header, quotes doubled, line breaks inside quotes kept; a byte-order
    mark before the first column is skipped by the reader."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")


def tagged(spark: SparkSession, parts: dict[str, str | None], schema: str) -> DataFrame:
    """All parts (path: domain) as one table; a part without a domain keeps its own.
    A missing path raises."""
    read = [csv_rows(spark, path, schema) if domain is None else csv_rows(spark, path, schema).withColumn("domain", F.lit(domain)) for path, domain in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read)


def existing(spark: SparkSession, path: str, schema: str) -> str:
    """The CSV folder, made without rows where a partitioned write had none for it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        spark.createDataFrame([], schema).write.csv(path, header=True, escape='"')
    return path


def optional_part(spark: SparkSession, path: str, schema: str, variant: int, round_name: str) -> DataFrame:
    """A part with its variant and round; missing or near-empty ones give no rows."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(where) and fs.getContentSummary(where).getLength() > EMPTY_BYTES:
        rows = csv_rows(spark, path, schema)
    else:
        rows = spark.createDataFrame([], schema)
    return rows.withColumn("variant_index", F.lit(variant)).withColumn("generation_round", F.lit(round_name))


def json_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)


def split_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Source and split of a corpus manifest; spaces around a split are dropped."""
    return csv_rows(spark, path, "source_id string, split_group string").select("source_id", F.trim("split_group").alias("split"))


def write_charset(chars: DataFrame, path: str, blank: str = "<BLANK>") -> None:
    """A vocabulary (char_id, ch) as one JSON object: blank, characters, both maps and
    the counts.  It is bounded by the code points there are."""
    pairs = F.array_sort(F.collect_list(F.struct("char_id", "ch")))
    one = chars.agg(pairs.alias("p")).select(
        F.lit(blank).alias("blank_token"), F.lit(0).alias("blank_id"), F.transform("p", lambda x: x.ch).alias("characters"),
        F.map_from_entries(F.transform("p", lambda x: F.struct(x.ch, x.char_id))).alias("char_to_id"),
        F.map_from_entries(F.transform("p", lambda x: F.struct(x.char_id.cast("string"), x.ch))).alias("id_to_char"),
        F.size("p").alias("num_characters"), (F.size("p") + 1).alias("num_classes"),
    )
    one.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def charset_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows (char_id, ch) of a vocabulary's JSON, whose keys are text, without blank."""
    held = spark.read.text(path, wholetext=True).select(F.from_json("value", "id_to_char map<string, string>").alias("v"))
    return held.select(F.explode("v.id_to_char").alias("k", "ch")).select(F.col("k").cast("int").alias("char_id"), "ch").where("char_id <> 0")


def append_csv(df: DataFrame, path: str) -> None:
    """Adds files to a CSV folder, columns in the order of what is there.

    The header of one existing file gives the order; a column missing here raises.
    """
    there = df.sparkSession.read.csv(path, header=True).columns
    df.select(*there).write.mode("append").csv(path, header=True, quote='"', escape='"')


def image_headers(spark: SparkSession, path: str) -> DataFrame:
    """Rows (path, length, sha256, width, height) of PNG files, the sizes from the
    header's bytes (null for other files)."""
    number = lambda at: F.conv(F.hex(F.substring("content", at, 4)), 16, 10).cast("int")
    png = F.hex(F.substring("content", 1, 8)) == "89504E470D0A1A0A"
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"), F.when(png, number(17)).alias("width"), F.when(png, number(21)).alias("height"))


PNG_MARK = b"\x89PNG\r\n\x1a\n"


def png_encoded(pixels: np.ndarray) -> bytes:
    """A gray image of 8 bits as PNG, rows unfiltered."""
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    h, w = pixels.shape
    rows = np.concatenate([np.zeros((h, 1), np.uint8), pixels], axis=1).tobytes()
    return PNG_MARK + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def _unfiltered(kind: int, row: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """A PNG row from its differences to the pixel left of, above and left above it."""
    if kind == 0:
        return row
    if kind == 1:
        return row.reshape(-1, step).cumsum(axis=0, dtype=np.uint8).reshape(-1)
    if kind == 2:
        return row + above
    out, up = [0] * step + row.tolist(), [0] * step + above.tolist()
    for i in range(step, len(out)):
        a, b, c = out[i - step], up[i], up[i - step]
        near = (a + b) // 2 if kind == 3 else min((a, b, c), key=lambda x: abs(a + b - c - x))
        out[i] = (out[i] + near) & 255
    return np.array(out[step:], np.uint8)


def png_decoded(data: bytes) -> np.ndarray | None:
    """Gray pixels of a PNG of 8 bits a channel, not interlaced, without a palette; colour
    is weighed into gray and transparency ignored.  None for anything else."""
    if not data.startswith(PNG_MARK) or len(data) < 33:
        return None
    w, h, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", data[16:29])
    step = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if depth != 8 or interlaced or step is None:
        return None
    at, body = 8, b""
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body += data[at + 8 : at + 8 + size] if kind == b"IDAT" else b""
        at += 12 + size
    try:
        flat = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, w * step + 1)
    except (zlib.error, ValueError):
        return None
    rows, above = [], np.zeros(w * step, np.uint8)
    for line in flat:
        above = _unfiltered(int(line[0]), line[1:], above, step)
        rows.append(above)
    x = np.stack(rows).reshape(h, w, step).astype(np.int64) if rows else np.zeros((0, w, step), np.int64)
    return (x[..., 0] if step < 3 else (x[..., 0] * 19595 + x[..., 1] * 38470 + x[..., 2] * 7471 + 32768) >> 16).astype(np.uint8)


def write_png(images: DataFrame, folder: str) -> DataFrame:
    """Writes ``images(name, height, width, data)`` as ``folder/name.png``; returns name
    and size of what was written.  A file appears when it is complete, and a task that
    runs again writes it again.  Rows whose data do not fit their size are left out."""
    fs, root = pafs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
    fs.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes = [], []
            for name, h, w, data in zip(*(c.to_pylist() for c in batch.columns)):
                if name is None or data is None or h is None or w is None or len(data) != h * w:
                    continue
                own, base = pafs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
                body = png_encoded(np.frombuffer(data, np.uint8).reshape(h, w))
                part = f"{base}/{name}.{uuid.uuid4().hex}.part"
                with own.open_output_stream(part) as out:
                    out.write(body)
                own.move(part, f"{base}/{name}.png")
                names.append(name)
                sizes.append(len(body))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["name", "bytes"])

    return images.select(F.col("name").cast("string"), "height", "width", "data").mapInArrow(run, "name string, bytes long")


def png_pixels(spark: SparkSession, path: str) -> DataFrame:
    """Rows (name, height, width, data) of the PNG files of a folder; what cannot be
    read has null height, width and data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [png_decoded(x) for x in batch.column(1).to_pylist()]
            of = lambda f: [None if x is None else f(x) for x in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(of(lambda x: x.shape[0]), pa.int32()), pa.array(of(lambda x: x.shape[1]), pa.int32()), pa.array(of(lambda x: x.tobytes()), pa.binary())], ["name", "height", "width", "data"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(path)
    return files.select(F.regexp_extract("path", r"([^/]*)\.png$", 1).alias("name"), "content").mapInArrow(run, "name string, height int, width int, data binary")


def yaml_config(spark: SparkSession, path: str) -> dict:
    """A YAML file as a dictionary; an empty file is an empty one."""
    import yaml

    return yaml.safe_load("".join(r.value for r in spark.read.text(path, wholetext=True).collect())) or {}


def standard_names(spark: SparkSession, folder: str) -> list[str]:
    """Copies files named like ``lines (1).csv`` to ``lines.csv`` and returns the new
    names.  Of several copies the one with the largest number is taken; a file that has
    the plain name is replaced."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    found: dict[str, tuple[int, str]] = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if m := re.fullmatch(r"(.+) \((\d+)\)(\.[^.]+)?", name):
            plain = m[1] + (m[3] or "")
            found[plain] = max(found.get(plain, (-1, "")), (int(m[2]), name))
    for plain, (_, name) in found.items():
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, jvm.org.apache.hadoop.fs.Path(root, name), fs, jvm.org.apache.hadoop.fs.Path(root, plain), False, True, conf)
    return sorted(found)


def write_if_passed(gate: DataFrame, write) -> None:
    """Calls ``write()`` unless a row of the gate says FAIL or is not passed; raises
    ValueError, with the gate's first such row, before anything is written."""
    failed = [F.col(c) == F.lit(v) for c, v in (("verdict", "FAIL"), ("passed", False)) if c in gate.columns]
    if not failed:
        raise ValueError("the gate has neither verdict nor passed")
    if bad := gate.where(reduce(lambda a, b: a | b, failed)).head():
        raise ValueError(f"not written: {bad.asDict()}")
    write()


def missing_paths(rows: DataFrame, files: DataFrame, column: str = "image_path") -> DataFrame:
    """Rows whose path's last part is not among the listed files."""
    listed = files.select(F.element_at(F.split("path", "/"), -1).alias("_name")).distinct()
    return rows.join(listed, F.element_at(F.split(F.regexp_replace(column, r"\\", "/"), "/"), -1) == F.col("_name"), "left_anti")


def write_csv(df: DataFrame, path: str, columns: list[str], order: list[str], mode: str = "overwrite") -> None:
    """Named columns in global order, as range-partitioned files with headers."""
    df.select(*columns).orderBy(*order).write.mode(mode).csv(path, header=True, quote='"', escape='"')


def write_manifest(df: DataFrame, path: str, splits: tuple[str, ...] = ("train", "val", "test")) -> None:
    """All rows under ``all``; rows of known splits, in any case, also by split."""
    df.write.mode("overwrite").parquet(f"{path}/all")
    by = df.withColumn("split_name", F.lower(F.trim("split")))
    by.where(F.col("split_name").isin(*splits)).write.mode("overwrite").partitionBy("split_name").parquet(f"{path}/by_split")


def write_text(df: DataFrame, path: str, column: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def markdown(df: DataFrame, title: str) -> str:
    """A report table of a small, already aggregated result; bars are escaped."""
    cell = lambda x: str("" if x is None else x).replace("|", "\\|")
    rows = [df.columns, ["---"] * len(df.columns), *df.toLocalIterator()]
    return f"# {title}\n\n" + "\n".join("| " + " | ".join(map(cell, r)) + " |" for r in rows) + "\n"


def report(title: str, sections: list[tuple[str, DataFrame | str]]) -> str:
    """A report of several headed sections, each a paragraph or a table of a small result."""
    body = [x if isinstance(x, str) else markdown(x, "").split("\n", 2)[2].strip() for _, x in sections]
    return f"# {title}\n\n" + "\n".join(f"## {name}\n\n{text}\n" for (name, _), text in zip(sections, body))
