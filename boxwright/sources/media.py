"""Images and frames: checks of image bytes, lists of files, images in memory, motion-JPEG frames, frame streams, scoring."""

from __future__ import annotations

import io
import json
import struct
import tarfile
import time
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from boxwright.sources.files import IMAGES, VIDEOS, images, suffix

HEAD = "format string, width int, height int"


def header(data: bytes | None) -> tuple[str | None, int | None, int | None]:
    """Format, width and height that the first bytes of an image state; nulls for anything else."""
    none = (None, None, None)
    try:
        if not data:
            return none
        if data[:8] == b"\x89PNG\r\n\x1a\n" and data[12:16] == b"IHDR":
            return ("png", *struct.unpack(">II", data[16:24]))
        if data[:2] == b"BM":
            w, h = struct.unpack("<ii", data[18:26])
            return ("bmp", w, abs(h))
        if data[:4] in (b"II*\0", b"MM\0*"):
            order = "<" if data[:1] == b"I" else ">"
            at = struct.unpack(order + "I", data[4:8])[0]
            found = {}
            for k in range(struct.unpack(order + "H", data[at : at + 2])[0]):
                tag, kind, _, raw = struct.unpack(order + "HHI4s", data[at + 2 + 12 * k : at + 14 + 12 * k])
                if tag in (256, 257):
                    found[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), raw[: 2 if kind == 3 else 4])[0]
            return ("tiff", found[256], found[257])
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            if data[12:16] == b"VP8X":
                return ("webp", 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little"))
            if data[12:16] == b"VP8L":
                bits = int.from_bytes(data[21:25], "little")
                return ("webp", 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF))
            if data[12:16] == b"VP8 ":
                w, h = struct.unpack("<HH", data[26:30])
                return ("webp", w & 0x3FFF, h & 0x3FFF)
        if data[:3] in (b"PF\n", b"Pf\n"):
            w, h = data[3:40].split()[:2]
            return ("pfm", int(w), int(h))
        if data[:3] == b"\xff\xd8\xff":
            at = 2
            while at + 9 < len(data):
                if data[at] != 0xFF:
                    return none
                kind = data[at + 1]
                if kind == 0xFF:  # fill byte
                    at += 1
                elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                    return ("jpeg", w, h)
                else:
                    at += 2 + (0 if kind == 0x01 or 0xD0 <= kind <= 0xD8 else struct.unpack(">H", data[at + 2 : at + 4])[0])
    except (struct.error, KeyError, ValueError, IndexError):
        pass
    return none


def _heads(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([header(x) for x in content], columns=["format", "width", "height"]).astype({"width": "Int32", "height": "Int32"})


def image_header(content: Column | str) -> Column:
    """format, width and height as a struct."""
    return F.pandas_udf(_heads, HEAD)(content)


def verified_images(rows: DataFrame) -> DataFrame:
    """Adds format, width, height and trailer (a JPEG that does not end as one must be restored) to rows of content."""
    head = rows.withColumn("head", image_header("content")).select("*", "head.*").drop("head")
    return head.withColumn("trailer", F.when(F.col("format") == "jpeg", F.hex(F.substring("content", -2, 2)) == "FFD9"))


def upload_status(name: Column, content: Column, head: Column, limit: int = 16 << 20) -> Column:
    """ok, suffix, empty, size or image (the bytes are none): what an upload check says; head is image_header(content)."""
    bad = ~suffix(name).isin("jpg", "jpeg", "png")
    return F.when(bad, "suffix").when(F.coalesce(F.octet_length(content), F.lit(0)) == 0, "empty").when(F.octet_length(content) > limit, "size").when(head["format"].isNull(), "image").otherwise("ok")


# scans


def listed(spark: SparkSession, list_file: str) -> DataFrame:
    """path of the images that a list file names, sorted."""
    parent = list_file.rsplit("/", 1)[0] if "/" in list_file else "."
    return listed_of(spark.read.text(list_file), parent).orderBy("path")


def listed_of(lines: DataFrame, parent: str) -> DataFrame:
    """path of lines (value) of a list file; './' stands for the folder of the file. Blank lines and unknown suffixes go."""
    value = F.trim("value")
    path = F.when(value.startswith("./"), F.concat(F.lit(parent + "/"), F.substr(value, F.lit(3)))).otherwise(value)
    return lines.select(path.alias("path")).where((F.col("path") != "") & suffix(F.col("path")).isin(IMAGES))


def scan(spark: SparkSession, *sources: str) -> DataFrame:
    """path, kind, length of files below folders, of glob patterns or of single files: images first, then videos, by path."""
    out = None
    for s in sources:
        rows = images(spark, s).drop("content")
        out = rows if out is None else out.unionByName(rows)
    return out.dropDuplicates(["path"]).orderBy("kind", "path")  # 'image' sorts before 'video'


def training_scan(spark: SparkSession, *sources: str) -> DataFrame:
    """path of the images of folders, glob patterns and list files (.txt), sorted, each once."""
    out = None
    for s in sources:
        rows = listed(spark, s) if s.endswith(".txt") else images(spark, s).where("kind = 'image'").select("path")
        out = rows if out is None else out.unionByName(rows)
    return out.distinct().orderBy("path")


def in_memory(spark: SparkSession, items: list) -> DataFrame:
    """image_id, name, content of bytes, arrays of the shape (height, width[, channels]) and paths that a caller holds.

    Arrays become raw bitmaps; paths are read here, as the caller's machine sees them.
    """
    import numpy as np

    rows = []
    for k, x in enumerate(items):
        if isinstance(x, (bytes, bytearray)):
            rows.append((k, f"image{k}", bytes(x)))
        elif isinstance(x, np.ndarray):
            rows.append((k, f"image{k}", bitmap(x)))
        else:
            rows.append((k, Path(x).name, Path(x).read_bytes()))
    return spark.createDataFrame(rows, "image_id long, name string, content binary")


def bitmap(a) -> bytes:
    """A 24-bit bitmap file of an array (height, width[, 3]) of bytes, red first."""
    import numpy as np

    a = np.repeat(a[:, :, None], 3, 2) if a.ndim == 2 else a[:, :, :3]
    h, w = a.shape[:2]
    rows = np.zeros((h, (3 * w + 3) // 4 * 4), np.uint8)
    rows[:, : 3 * w] = a[::-1, :, ::-1].reshape(h, 3 * w)
    return b"BM" + struct.pack("<IIIIiiHHIIiiII", 54 + rows.size, 0, 54, 40, w, h, 1, 24, 0, rows.size, 2835, 2835, 0, 0) + rows.tobytes()


# frames

#: Frames and bytes of frames at which a batch leaves a Python worker.
FRAMES, FRAME_BYTES = 4096, 8 << 20


def split_frames(data: bytes, stride: int = 1) -> Iterator[tuple[int, bytes]]:
    """(number, JPEG) of each stride-th frame of motion JPEG, plain or in a container that stores its frames whole."""
    at, number = data.find(b"\xff\xd8\xff"), 0
    while at >= 0:
        end = data.find(b"\xff\xd9", at)
        if end < 0:
            return
        number += 1
        if number % stride == 0:
            yield number, data[at : end + 2]
        at = data.find(b"\xff\xd8\xff", end + 2)


def video_frames(spark: SparkSession, folder: str, stride: int = 1) -> DataFrame:
    """path, frame_no (from 1), payload, width, height of each stride-th frame of the motion-JPEG videos below a folder.

    A video is read by one task, and frames leave it in batches of bounded size. Other codecs need a decoder, which is not at hand.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return frames_of(files.where(suffix(F.col("path")).isin([*VIDEOS, "mjpeg", "mjpg"])), stride)


def frame_batches(batches: Iterator[pa.RecordBatch], stride: int = 1) -> Iterator[pa.RecordBatch]:
    """Frames of batches of path and content, in batches of up to FRAMES frames, which end where FRAME_BYTES are reached."""

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"path": pa.string(), "frame_no": pa.int64(), "payload": pa.binary(), "width": pa.int32(), "height": pa.int32()}
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)], list(kinds))

    rows, held = [], 0
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            name = path.as_py()
            for number, payload in split_frames(content.as_py() or b"", stride):
                rows.append((name, number, payload, *header(payload)[1:]))
                held += len(payload)
                if len(rows) >= FRAMES or held >= FRAME_BYTES:
                    yield packed(rows)
                    rows, held = [], 0
    if rows:
        yield packed(rows)


def frames_of(videos: DataFrame, stride: int = 1) -> DataFrame:
    """video_frames() of rows of path and content."""
    schema = "path string, frame_no long, payload binary, width int, height int"
    return videos.select("path", "content").mapInArrow(lambda batches: frame_batches(batches, stride), schema)


def frame_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of source_id, ts, frame_no, label, payload: each camera drops its frames as <folder>/<source>/<number>.<suffix>.

    Read with ``frames.latest`` in update mode, only the newest frame of a source is seen, whatever piles up.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(folder)
    name = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return files.select(F.element_at(F.split("path", "/"), -2).alias("source_id"), F.col("modificationTime").alias("ts"), name.try_cast("long").alias("frame_no"), F.lit(None).cast("string").alias("label"), F.col("content").alias("payload"))


def stop_when_any_ends(query: StreamingQuery, ended: Callable[[], bool], poll: float = 0.5, timeout: float | None = None) -> bool:
    """Stops a query as soon as ``ended`` says that a source has; its last rows are processed first. True if it was stopped here."""
    start = time.monotonic()
    while query.isActive and (timeout is None or time.monotonic() - start < timeout):
        if ended():
            query.processAllAvailable()
            query.stop()
            return True
        query.awaitTermination(poll)
    return False


class Hooks(StreamingQueryListener):
    """Callbacks by name: ``on_started``, ``on_progress``, ``on_idle``, ``on_terminated``; several for each name, in order."""

    NAMES = ("on_started", "on_progress", "on_idle", "on_terminated")

    def __init__(self) -> None:
        super().__init__()
        self.actions: dict[str, list[tuple[str, Callable]]] = {n: [] for n in self.NAMES}

    def register(self, hook: str, action: Callable, name: str = "") -> None:
        if hook not in self.actions:
            raise ValueError(f"no hook {hook!r}; hooks are {', '.join(self.NAMES)}")
        self.actions[hook].append((name, action))

    def run(self, hook: str, event) -> None:
        for _, action in self.actions[hook]:
            action(event)

    def onQueryStarted(self, event) -> None:
        self.run("on_started", event)

    def onQueryProgress(self, event) -> None:
        self.run("on_progress", event)

    def onQueryIdle(self, event) -> None:
        self.run("on_idle", event)

    def onQueryTerminated(self, event) -> None:
        self.run("on_terminated", event)


# scoring

_MODELS: dict[str, object] = {}


def scored(rows: DataFrame, key: str, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """Rows through a model: ``load`` gives it once a worker process (by ``key``), and it maps Arrow batches to ``schema``.

    For raw detections the schema is that of multi-label expansion: image_id, obj, scores and a box.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if key not in _MODELS:
            _MODELS[key] = load()
        for f in frames:
            yield _MODELS[key](f)

    return rows.mapInPandas(run, schema)


# dataset archives


def unpacked(archive: str, folder: str) -> str:
    """Path of the dataset description in a zip or tar archive, which is unpacked into the folder; the shallowest .yaml counts.

    Members that would leave the folder are refused.
    """
    root = Path(folder).resolve()
    root.mkdir(parents=True, exist_ok=True)
    if zipfile.is_zipfile(archive):
        with zipfile.ZipFile(archive) as z:
            for name in z.namelist():
                if not (root / name).resolve().is_relative_to(root):
                    raise ValueError(f"{name} lies outside the folder")
            z.extractall(root)
    else:
        with tarfile.open(archive) as t:
            t.extractall(root, filter="data")
    found = sorted((p for p in root.rglob("*.y*ml") if p.suffix in (".yaml", ".yml")), key=lambda p: (len(p.parts), str(p)))
    if not found:
        raise FileNotFoundError("the archive has no .yaml file")
    return str(found[0])


def next_path(path: str, sep: str = "", limit: int = 9999) -> str:
    """The path itself if it is free, else with the least number from 2 that is; a suffix stays at the end."""
    p = Path(path)
    if not p.exists():
        return path
    stem, ending = (p.with_suffix(""), p.suffix) if p.is_file() else (p, "")
    return next(str(q) for n in range(2, limit) if not (q := Path(f"{stem}{sep}{n}{ending}")).exists())


def write_label_cache(rows: DataFrame, digest: str, path: str, version: str = "1") -> None:
    """Label rows as Parquet beside a manifest of the files' digest and the format's version."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}/rows")
    spark.createDataFrame([(json.dumps({"digest": digest, "version": version}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def read_label_cache(spark: SparkSession, digest: str, path: str, version: str = "1") -> DataFrame | None:
    """The cached rows; None if there are none or they are of other files or another version."""
    from pyspark.errors import AnalysisException

    try:
        held = json.loads(spark.read.text(f"{path}/manifest").first().value)
        return spark.read.parquet(f"{path}/rows") if held == {"digest": digest, "version": version} else None
    except AnalysisException:
        return None


def crops(rows: DataFrame, decode: Callable[[bytes], object]) -> DataFrame:
    """image_id, det_id, cls, content: bitmaps of boxes (x1..y2 in pixels) cut from content; ``decode`` gives (height, width, 3).

    Empty cuts are left out.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                part = decode(r.content)[max(0, int(r.y1)) : int(r.y2), max(0, int(r.x1)) : int(r.x2)]
                if part.size:
                    out.append((r.image_id, r.det_id, r.cls, bitmap(part)))
            yield pd.DataFrame(out, columns=["image_id", "det_id", "cls", "content"])

    return rows.select("image_id", "det_id", "cls", "x1", "y1", "x2", "y2", "content").mapInPandas(run, "image_id long, det_id long, cls int, content binary")


def write_class_folders(cut: DataFrame, folder: str) -> None:
    """Cuts (image_id, det_id, cls, content) as a dataset with a folder a class, each file <image>_<box>.bmp."""
    cut.withColumn("name", F.concat_ws("_", F.col("image_id").cast("string"), F.col("det_id").cast("string"))).write.partitionBy("cls").mode("append").parquet(folder)


def decoded_bitmap(data: bytes):
    """(height, width, 3) of a 24-bit bitmap, red first: the decoder that needs no library."""
    import numpy as np

    f = io.BytesIO(data)
    f.seek(10)
    at = struct.unpack("<I", f.read(4))[0]
    w, h = struct.unpack("<ii", data[18:26])
    row = (3 * w + 3) // 4 * 4
    a = np.frombuffer(data, np.uint8, row * abs(h), at).reshape(abs(h), row)[:, : 3 * w].reshape(abs(h), w, 3)[:, :, ::-1]
    return a[::-1] if h > 0 else a
