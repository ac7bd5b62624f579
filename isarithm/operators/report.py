"""Reports: costs, counters, joined tables, stale pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isarithm.functions import texts


def left_report(names: DataFrame, key: str, **tables: tuple[DataFrame, str]) -> DataFrame:
    """The names with each table's column, 0 where it has none; tables are one row per key."""
    out = names
    for column, (table, source) in tables.items():
        out = out.join(table.select(key, F.col(source).alias(column)), key, "left").fillna({column: 0})
    return out


def in_order(names: list[str], table: DataFrame, key: str) -> DataFrame:
    """The table's rows of the listed names, with their position; unknown names are skipped."""
    wanted = F.posexplode(F.array(*[F.lit(n) for n in names])).alias("pos", key)
    return table.sparkSession.range(1).select(wanted).join(table, key)


def counter(values: DataFrame, by: Column, name: str = "kind") -> DataFrame:
    return values.select(by.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))


def as_map(counts: DataFrame, name: str = "kind", n: str = "n") -> DataFrame:
    """One row: all counts as a map, in order of name. The counts must be few."""
    return counts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(name, n)))).alias("counts"))


def stale(existing: DataFrame, written: DataFrame, key: str) -> DataFrame:
    """Keys that exist and were not written this time, once each."""
    return existing.select(key).distinct().join(written.select(key), key, "left_anti")


def page_order(name: Column) -> list[Column]:
    """Sort keys that put names ending in -test last."""
    return [name.endswith("-test"), name]


def vram_gb(pixels: Column) -> Column:
    """Video memory of a texture with its smaller copies, four bytes a pixel and a third more."""
    return pixels * 16.0 / 3.0 / float(2**30)


def cost_rows(reports: DataFrame) -> DataFrame:
    """Cost rows from build reports: name, triangles, meshes, megabytes, blocked gates, texture memory."""
    blocked = F.transform(F.filter(F.coalesce("clearance", F.array().cast("array<struct<gate: int, clear: boolean>>")), lambda g: ~g["clear"]), lambda g: g["gate"])
    return reports.select("map", "triangles", "meshes", (F.col("size_bytes") / 1e6).alias("mb"), blocked.alias("blocked_gates"), vram_gb(F.coalesce("texture_px", F.lit(0))).alias("vram_gb"))


def markdown(table: DataFrame, columns: list[str], order: list[Column]) -> DataFrame:
    """One row: a Markdown table of a bounded report, in order; missing values print "-"."""
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]), F.lit(" |"))
    keys = [k.alias(f"k{i}") for i, k in enumerate(order)]
    head = "| " + " | ".join(columns) + " |\n|" + "---|" * len(columns)
    rows = table.agg(F.sort_array(F.collect_list(F.struct(*keys, cells.alias("line")))).alias("rows"))
    return rows.select(F.concat(F.lit(head + "\n"), F.array_join(F.transform("rows", lambda r: r["line"]), "\n")).alias("page"))


def redacted(reports: DataFrame, private: str, secret: list[str], sources: str | None = None) -> DataFrame:
    """Reports with the secret columns, and the files of their sources, null where a report is private."""
    hide = F.coalesce(F.col(private), F.lit(False))
    out = reports.withColumns({c: F.when(~hide, F.col(c)) for c in secret})
    if sources:
        out = out.withColumn(sources, F.when(hide, F.transform(sources, lambda s: s.withField("files", F.lit(None).cast("array<string>")))).otherwise(F.col(sources)))
    return out


def to_lines(reports: DataFrame, name: str) -> DataFrame:
    """(name, json): every report as one line of JSON; missing values are left out."""
    return reports.select(name, F.to_json(F.struct(*[F.col(f"`{c}`") for c in reports.columns])).alias("json"))


def texture_pixels(side: Column, tiles: Column, cap: Column) -> Column:
    """Upper bound of a map's texture pixels: the ground's square and each survey tile at its cap."""
    return side * side + F.coalesce(tiles * cap * cap, F.lit(0))


def cached(spark, path: str, build, fresh: bool = False) -> DataFrame:
    """The table at a path, built and written first if it is not there. Put what it depends on into the path."""
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if fresh or not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def thousands(value: Column) -> Column:
    return texts.dash(value, F.format_number(value, 0))


def sheets_in(box: tuple[float, float, float, float], size: int) -> Column:
    """Sorted numbers of the sheets of a size (1000 or 5000) that a box touches; an edge on a border adds none."""
    xmin, ymin, xmax, ymax = box
    last = lambda v: -(-(v - 1e-6) // size) - 1
    span = lambda a, b: F.sequence(F.lit(int(a // size)), F.lit(int(max(a // size, last(b)))))
    name = texts.sheet_1km if size == 1000 else texts.sheet_5km
    names = F.transform(span(xmin, xmax), lambda i: F.transform(span(ymin, ymax), lambda j: name((i * size).cast("double"), (j * size).cast("double"))))
    return F.array_sort(F.array_distinct(F.flatten(names)))


def area_report(spark, name: str, box: tuple[float, float, float, float], chunk: float = 250.0) -> DataFrame:
    """One row about a map's area: box, corners in degrees, sheets of both sizes, chunks."""
    from isarithm.functions.projection import conic_inverse

    xmin, ymin, xmax, ymax = box
    corner = lambda x, y: F.struct(*[F.round(v, 6).alias(k) for k, v in zip(("lat", "lon"), conic_inverse(F.lit(x), F.lit(y)), strict=True)])
    return spark.range(1).select(
        F.lit(name).alias("map"), F.lit((xmax - xmin) / 1000).alias("width_km"), F.lit((ymax - ymin) / 1000).alias("height_km"), corner(xmin, ymin).alias("south_west"), corner(xmax, ymax).alias("north_east"),
        F.lit(int(-(-(xmax - xmin) // chunk)) * int(-(-(ymax - ymin) // chunk))).alias("chunks"), sheets_in(box, 1000).alias("sheets_1km"), sheets_in(box, 5000).alias("sheets_5km"),
    )
