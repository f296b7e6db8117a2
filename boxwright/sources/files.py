"""Readers of label, annotation and log files, and writers of results. Bad rows are kept with a status, never raised."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Image and video suffixes that a scan accepts.
IMAGES = "bmp dng jpeg jpg mpo png tif tiff webp pfm".split()
VIDEOS = "asf avi gif m4v mkv mov mp4 mpeg mpg ts wmv".split()


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def label_path(path: Column) -> Column:
    """The last /images/ becomes /labels/, and the suffix .txt."""
    return F.concat(F.regexp_replace(F.regexp_replace(path, r"^(.*)/images/", "$1/labels/"), r"\.[^./]*$", ""), F.lit(".txt"))


def images(spark: SparkSession, folder: str) -> DataFrame:
    """path, kind (image or video), length of the files below a folder; content is read by no plan that does not select it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    kind = F.when(suffix(F.col("path")).isin(IMAGES), "image").when(suffix(F.col("path")).isin(VIDEOS), "video")
    return files.select("path", kind.alias("kind"), "length", "content").where(kind.isNotNull())


def folder_classes(rows: DataFrame) -> DataFrame:
    """Adds name, the folder of each path, and cls, its number among the sorted names (a row a class)."""
    rows = rows.withColumn("name", F.element_at(F.split("path", "/"), -2))
    names = rows.select("name").distinct().agg(F.sort_array(F.collect_list("name")).alias("names"))
    return rows.crossJoin(F.broadcast(names)).withColumn("cls", (F.array_position("names", F.col("name")) - 1).cast("int")).drop("names")


def class_folders(spark: SparkSession, folder: str) -> DataFrame:
    """path, name, cls of images whose folder is their class."""
    return folder_classes(images(spark, folder).select("path"))


def label_rows(spark: SparkSession, folder: str) -> DataFrame:
    """path, line, cls, x, y, w, h, points, status of all label files.

    Spark's file sources skip files of no bytes, so those look missing in a left join with the images; blank ones are
    ``empty``. A file with a row of more than six fields is a polygon file: its boxes come from the points. Other rows need five.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(folder)
    return labels_of(files.select("path", F.col("content").cast("string").alias("value")))


def labels_of(files: DataFrame) -> DataFrame:
    """label_rows() of whole label files (path, value)."""
    lines = F.filter(F.transform(F.split("value", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    fields = F.transform(lines, lambda x: F.transform(F.split(x, r"\s+"), lambda v: v.try_cast("double")))
    rows = files.withColumn("rows", fields).withColumn("polygon", F.exists("rows", lambda r: F.size(r) > 6)).select("path", "polygon", F.posexplode_outer("rows").alias("line", "f"))
    f, n = F.col("f"), F.size("f")
    points = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / 2).cast("int") - 1), lambda k: F.struct(F.get(f, 2 * k + 1).alias("x"), F.get(f, 2 * k + 2).alias("y")))
    rows = rows.withColumn("points", F.when(F.col("polygon") & (n >= 7), points))
    xs, ys = F.transform("points", lambda p: p["x"]), F.transform("points", lambda p: p["y"])
    mid = lambda a: (F.array_min(a) + F.array_max(a)) / 2
    size = lambda a: F.array_max(a) - F.array_min(a)
    box = {c: F.when(F.col("points").isNotNull(), p).otherwise(F.get(f, F.lit(k))) for k, (c, p) in enumerate((("x", mid(xs)), ("y", mid(ys)), ("w", size(xs)), ("h", size(ys))), 1)}
    rows = rows.withColumns({"cls": F.get(f, F.lit(0)), **box})
    values = [F.col(c) for c in ("cls", "x", "y", "w", "h")]
    bad = F.exists(f, lambda v: v.isNull()) | (~F.col("polygon") & (n != 5)) | (F.col("polygon") & F.col("points").isNull())
    status = F.when(f.isNull(), "empty").when(bad, "fields").when(F.least(*values) < 0, "negative").when(F.greatest(*values[1:]) > 1, "outside").otherwise("ok")
    return rows.select("path", "line", "cls", "x", "y", "w", "h", "points", status.alias("status"))


def dataset_yaml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(split, path) and (cls, name) of a dataset description: flat keys, one list or mapping level."""
    splits, names, key, base = [], [], None, ""
    for raw in Path(path).read_text().splitlines():
        line = raw.split(" #")[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if line[0] in " -":
            item = line.strip().removeprefix("- ").strip()
            if key == "names":
                k, _, v = item.rpartition(":")
                names.append((int(k) if k else len(names), v.strip().strip("'\"")))
            elif key in ("train", "val", "test"):
                splits.append((key, item))
            continue
        key, _, value = (x.strip() for x in line.partition(":"))
        if key == "path":
            base = value
        elif key in ("train", "val", "test") and value:
            splits += [(key, v.strip().strip("'\"")) for v in value.strip("[]").split(",")]
        elif key == "names" and value:
            names += [(k, v.strip().strip("'\"")) for k, v in enumerate(value.strip("[]").split(","))]
    joined = [(s, p if p.startswith("/") or not base else f"{base.rstrip('/')}/{p}") for s, p in splits]
    return spark.createDataFrame(joined, "split string, path string"), spark.createDataFrame(names, "cls int, name string")


def coco_annotations(spark: SparkSession, path: str) -> DataFrame:
    """image, name, x, y, w, h (clipped, normalised centre) of annotations that are no crowds."""
    doc = spark.read.option("multiLine", "true").json(path)
    parts = (doc.select(F.explode(c).alias("r")).select("r.*") for c in ("images", "categories", "annotations"))
    return coco_of(*parts)


def coco_of(images_: DataFrame, categories: DataFrame, annotations: DataFrame) -> DataFrame:
    """coco_annotations() of images (id, file_name, width, height), categories (id, name) and annotations (image_id, category_id, bbox, iscrowd)."""
    image = images_.select(F.col("id").alias("image_id"), "file_name", F.col("width").alias("iw"), F.col("height").alias("ih"))
    names = categories.select(F.col("id").alias("category_id"), "name")
    rows = annotations.where("iscrowd = 0").select("image_id", "category_id", *(F.col("bbox")[k].cast("double").alias(c) for k, c in enumerate(("x0", "y0", "bw", "bh"))))
    rows = rows.join(image, "image_id").join(names, "category_id")
    x1, y1 = F.greatest("x0", F.lit(0.0)), F.greatest("y0", F.lit(0.0))
    x2, y2 = F.least(F.col("x0") + F.col("bw"), "iw"), F.least(F.col("y0") + F.col("bh"), "ih")
    return rows.select(F.col("file_name").alias("image"), "name", ((x1 + x2) / 2 / F.col("iw")).alias("x"), ((y1 + y2) / 2 / F.col("ih")).alias("y"), ((x2 - x1) / F.col("iw")).alias("w"), ((y2 - y1) / F.col("ih")).alias("h"))


VOC = "filename string, size struct<width:double,height:double>, object array<struct<name:string,difficult:int,bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>"


def voc_annotations(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """image, cls, x, y, w, h of the objects of known classes that are not difficult; centres are one pixel up and left."""
    return _voc(spark.read.format("xml").option("rowTag", "annotation").schema(VOC).load(path), names)


def voc_of(files: DataFrame, names: list[str]) -> DataFrame:
    """voc_annotations() of whole XML files (value)."""
    return _voc(files.select(F.from_xml("value", VOC).alias("a")).select("a.*"), names)


def _voc(rows: DataFrame, names: list[str]) -> DataFrame:
    rows = rows.select("filename", "size", F.explode("object").alias("o")).where((F.coalesce("o.difficult", F.lit(0)) != 1) & F.col("o.name").isin(names))
    b, iw, ih = F.col("o.bndbox"), F.col("size.width"), F.col("size.height")
    at = F.array_position(F.array(*map(F.lit, names)), F.col("o.name")) - 1
    return rows.select(F.col("filename").alias("image"), at.cast("int").alias("cls"), (((b["xmin"] + b["xmax"]) / 2 - 1) / iw).alias("x"), (((b["ymin"] + b["ymax"]) / 2 - 1) / ih).alias("y"), ((b["xmax"] - b["xmin"]) / iw).alias("w"), ((b["ymax"] - b["ymin"]) / ih).alias("h"))


DRONE = "x double, y double, w double, h double, score string, cls int"
SHELF = "image string, x1 double, y1 double, x2 double, y2 double, name string, iw double, ih double"


def drone_rows(spark: SparkSession, path: str) -> DataFrame:
    """path, cls, x, y, w, h in pixels of comma-separated rows; ignored regions (fifth field 0) go, classes start at 0."""
    return _drone(spark.read.schema(DRONE).csv(path).select("*", F.col("_metadata.file_path").alias("path")))


def drone_of(lines: DataFrame) -> DataFrame:
    """drone_rows() of lines (path, value)."""
    return _drone(lines.select("path", F.from_csv("value", DRONE).alias("r")).select("path", "r.*"))


def _drone(rows: DataFrame) -> DataFrame:
    return rows.where(F.trim("score") != "0").select("path", (F.col("cls") - 1).alias("cls"), (F.col("x") + F.col("w") / 2).alias("x"), (F.col("y") + F.col("h") / 2).alias("y"), "w", "h")


def shelf_rows(spark: SparkSession, path: str) -> DataFrame:
    """image, cls 0, x, y, w, h (normalised) of rows image, x1, y1, x2, y2, class, width, height without header."""
    return _shelf(spark.read.schema(SHELF).csv(path))


def shelf_of(lines: DataFrame) -> DataFrame:
    """shelf_rows() of lines (value)."""
    return _shelf(lines.select(F.from_csv("value", SHELF).alias("r")).select("r.*"))


def _shelf(r: DataFrame) -> DataFrame:
    return r.select("image", F.lit(0).alias("cls"), ((F.col("x1") + F.col("x2")) / 2 / F.col("iw")).alias("x"), ((F.col("y1") + F.col("y2")) / 2 / F.col("ih")).alias("y"), ((F.col("x2") - F.col("x1")) / F.col("iw")).alias("w"), ((F.col("y2") - F.col("y1")) / F.col("ih")).alias("h"))


def positional_json(spark: SparkSession, path: str, width: float = 1920, height: float = 1200) -> DataFrame:
    """image, cls, x, y, w, h where an annotation names its image by position in the list."""
    doc = spark.read.option("multiLine", "true").json(path)
    listed = doc.select(F.posexplode("images").alias("image_id", "i")).select(F.col("image_id").cast("long").alias("image_id"), F.col("i.name").alias("image"))
    return positional_of(listed, doc.select(F.explode("annotations").alias("a")).select("a.image_id", "a.category_id", "a.bbox"), width, height)


def positional_of(listed: DataFrame, annotations: DataFrame, width: float = 1920, height: float = 1200) -> DataFrame:
    """positional_json() of places (image_id, image) and annotations (image_id, category_id, bbox)."""
    rows = annotations.select("image_id", F.col("category_id").alias("cls"), *(F.col("bbox")[k].cast("double").alias(c) for k, c in enumerate(("x0", "y0", "bw", "bh"))))
    return rows.join(listed, "image_id").select("image", "cls", ((F.col("x0") + F.col("bw") / 2) / width).alias("x"), ((F.col("y0") + F.col("bh") / 2) / height).alias("y"), (F.col("bw") / width).alias("w"), (F.col("bh") / height).alias("h"))


def geojson_rows(spark: SparkSession, path: str, lookup: list[int]) -> DataFrame:
    """image, cls, x1, y1, x2, y2 of features whose type maps to a class (lookup is -1 elsewhere) and whose bounds parse."""
    doc = spark.read.option("multiLine", "true").json(path).select(F.explode("features.properties").alias("p"))
    return geojson_of(doc.select("p.image_id", "p.type_id", "p.bounds_imcoords"), lookup)


def geojson_of(features: DataFrame, lookup: list[int]) -> DataFrame:
    """geojson_rows() of properties (image_id, type_id, bounds_imcoords)."""
    b = F.transform(F.split("bounds_imcoords", ","), lambda v: v.try_cast("double"))
    rows = features.select(F.col("image_id").alias("image"), F.get(F.array(*map(F.lit, lookup)), F.col("type_id").cast("int")).alias("cls"), b.alias("b"))
    return rows.where((F.size("b") == 4) & ~F.exists("b", lambda v: v.isNull()) & (F.col("cls") >= 0)).select("image", "cls", *(F.col("b")[k].alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))))


def split_bridge(splits: DataFrame, images: DataFrame) -> DataFrame:
    """split, path of the images below each split's folders: an image may be in several splits."""
    return images.join(F.broadcast(splits.withColumnRenamed("path", "folder")), F.expr("startswith(path, folder)")).select("split", "path").distinct()


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """A padded CSV log with trimmed headers and numeric columns."""
    rows = spark.read.option("header", "true").option("ignoreLeadingWhiteSpace", "true").option("ignoreTrailingWhiteSpace", "true").option("inferSchema", "true").csv(path)
    return rows.toDF(*[c.strip() for c in rows.columns])


def numeric_rows(spark: SparkSession, path: str) -> DataFrame:
    """line values of white-space separated numbers as array<double>."""
    return spark.read.text(path).select(numbers(F.col("value")).alias("values"))


def numbers(line: Column) -> Column:
    """The numbers of a line; null where a field is none."""
    return F.transform(F.split(F.trim(line), r"\s+"), lambda v: v.try_cast("double"))


def jpeg_ok(content: Column) -> Column:
    """Whether the bytes end with the JPEG trailer."""
    return F.hex(F.substring(content, -2, 2)) == "FFD9"


# writers


def shortest(c: Column, digits: int = 6) -> Column:
    """A number as %g prints it between 1e-4 and 1e6: six significant digits, no trailing zeros."""
    scale = F.greatest(F.lit(0), F.lit(digits - 1) - F.floor(F.log10(F.when(F.abs(c) > 0, F.abs(c)).otherwise(1.0))).cast("int"))
    text = F.format_string("%.12f", F.bround(c * F.pow(F.lit(10.0), scale)) / F.pow(F.lit(10.0), scale))
    return F.regexp_replace(F.regexp_replace(text, r"0+$", ""), r"\.$", "")


def label_text(rows: DataFrame, with_conf: bool = True) -> DataFrame:
    """image_id, value: one text line a row: class, centre box, and confidence."""
    parts = ["x", "y", "w", "h", *(["conf"] if with_conf else [])]
    return rows.select("image_id", F.concat_ws(" ", F.col("cls").cast("string"), *(shortest(F.col(c)) for c in parts)).alias("value"))


def corner_text(rows: DataFrame, with_conf: bool = True) -> DataFrame:
    """image_id, value: one text line a row: class, whole-pixel corners as they are, and confidence."""
    parts = [F.col(c).cast("string") for c in ("x1", "y1", "x2", "y2")] + ([shortest(F.col("conf"))] if with_conf else [])
    return rows.select("image_id", F.concat_ws(" ", F.col("cls").cast("string"), *parts).alias("value"))


def write_label_text(rows: DataFrame, folder: str) -> None:
    """One folder of text an image."""
    rows.repartition("image_id").write.partitionBy("image_id").mode("append").text(folder)


def coco_results(rows: DataFrame, category: Column | None = None) -> DataFrame:
    """image_id, category_id, bbox (top left, 3 places), score (5 places), all half-even."""
    r = F.bround
    box = F.array(*(r(c.cast("double"), 3) for c in (F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))))
    return rows.select("image_id", (category if category is not None else F.col("cls")).alias("category_id"), box.alias("bbox"), r(F.col("conf"), 5).alias("score"))


def result_frame(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """xmin, ymin, xmax, ymax, confidence, class, name; the class dimension is broadcast by its own small size."""
    return rows.join(classes, "cls", "left").select(F.col("x1").alias("xmin"), F.col("y1").alias("ymin"), F.col("x2").alias("xmax"), F.col("y2").alias("ymax"), F.col("conf").alias("confidence"), F.col("cls").alias("class"), "name")


def result_records(rows: DataFrame, classes: DataFrame, key: list[str]) -> DataFrame:
    """The key columns and json, the record of result_frame()."""
    fields = {"xmin": "x1", "ymin": "y1", "xmax": "x2", "ymax": "y2", "confidence": "conf", "class": "cls", "name": "name"}
    return rows.join(classes, "cls", "left").select(*key, F.to_json(F.struct(*(F.col(c).alias(n) for n, c in fields.items()))).alias("json"))


def with_masks(results: DataFrame, rle: DataFrame, key: list[str], height: int, width: int) -> DataFrame:
    """COCO results with segmentation (size: height and width; counts), from run-length counts of the same key; no mask, no row."""
    seg = F.struct(F.array(F.lit(height), F.lit(width)).alias("size"), F.col("counts").alias("counts"))
    return results.join(rle.select(*key, seg.alias("segmentation")), key)


def prediction_rows(rows: DataFrame) -> DataFrame:
    """image, name, confidence with two decimals."""
    return rows.select(F.col("image_id").alias("image"), "name", F.format_string("%.2f", "conf").alias("confidence"))


def write_predictions(rows: DataFrame, path: str) -> None:
    """prediction_rows() as CSV with a header."""
    prediction_rows(rows).write.mode("append").option("header", "true").csv(path)


def summary_text(rows: DataFrame) -> DataFrame:
    """image_id, said: counts of its detections by class name, as '2 persons, 1 dog'."""
    n = rows.groupBy("image_id", "cls", "name").agg(F.count("*").alias("n"))
    part = F.concat(F.col("n").cast("string"), F.lit(" "), "name", F.when(F.col("n") > 1, "s").otherwise(""))
    return n.groupBy("image_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("cls", part.alias("p")))), lambda x: x["p"]), ", ").alias("said"))


def top_text(scores: Column, names: Column, k: int = 5) -> Column:
    """The k best classes as lines of probability and name."""
    best = F.slice(F.array_sort(F.transform(scores, lambda s, i: F.struct((-s).alias("neg"), i.alias("i")))), 1, k)
    return F.array_join(F.transform(best, lambda b: F.concat(F.format_string("%.2f", -b["neg"]), F.lit(" "), F.get(names, b["i"]))), "\n")
