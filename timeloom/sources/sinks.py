"""What leaves the engine: side files per song, merged tracks, manifests, packages, reports.

Spark's committers write whole files or none. Nulls are left out of JSON.
"""

from __future__ import annotations

import io
import zipfile
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.functions import notation


def write_json(rows: DataFrame, path: str, by: list[str] | None = None, mode: str = "error") -> None:
    """JSON lines, a folder per value of ``by``; not-a-number and infinite doubles are an error."""
    doubles = [c for c, k in rows.dtypes if k in ("double", "float")]
    bad = reduce(lambda a, b: a | b, (F.isnan(c) | (F.abs(c) == float("inf")) for c in doubles), F.lit(False))
    checked = rows.withColumn("_ok", F.assert_true(~F.coalesce(bad, F.lit(False)), F.lit("a number is not finite"))).where("_ok is null").drop("_ok") if doubles else rows
    out = checked.write.mode(mode)
    (out.partitionBy(*by) if by else out).json(path)


def write_cache(rows: DataFrame, root: str, settings: dict) -> str:
    """Writes under a folder named by the SHA-256 of the settings and returns it; what is there is replaced."""
    import hashlib

    from timeloom.sources.files import canonical_json

    path = f"{root}/{hashlib.sha256(canonical_json(settings).encode()).hexdigest()}"
    rows.write.mode("overwrite").parquet(path)
    return path


def write_csv(tables: list[DataFrame], path: str) -> None:
    """Rows of all tables under the union of their columns, in order of name."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    whole.select(*sorted(whole.columns)).write.option("header", True).csv(path)


def arrangements(notes: DataFrame, tracks: DataFrame) -> DataFrame:
    """One row a track: its manifest entry (id, name, file) and its notes as an array in order."""
    order = F.array_sort(F.collect_list(F.struct("t", "note")))
    gathered = notes.groupBy("song", "track").agg(F.transform(order, lambda s: s["note"]).alias("notes"))
    made = tracks.join(gathered, ["song", "track"]).withColumn("id", notation.safe_id(F.col("track"), F.col("track_index")))
    return made.withColumn("file", F.concat(F.lit("arrangements/"), "id", F.lit(".json")))


def with_notation(entries: DataFrame, notations: DataFrame) -> DataFrame:
    """Entries with the notation file of their id, where there is one."""
    return entries.join(notations.select("song", "id", F.concat(F.lit("notation/"), "id", F.lit(".json")).alias("notation_file")), ["song", "id"], "left")


def drum_tab(hits: DataFrame) -> DataFrame:
    """(song, kit, hits): the pieces that are hit, and all hits in order."""
    return hits.groupBy("song").agg(F.array_sort(F.collect_set("piece")).alias("kit"), F.array_sort(F.collect_list(F.struct("t", "piece", "velocity"))).alias("hits"))


def keys_file(events: DataFrame) -> DataFrame:
    return events.groupBy("song").agg(F.array_sort(F.collect_list(F.struct("t", "key"))).alias("events"))


def timeline_file(beats: DataFrame, tempos: DataFrame, meters: DataFrame | None = None) -> DataFrame:
    """(song, beats, tempos, time_signatures); a song without any of one kind has null there, which JSON leaves out."""
    gathered = [beats.groupBy("song").agg(F.array_sort(F.collect_list(F.struct("time", "measure"))).alias("beats")), tempos.groupBy("song").agg(F.array_sort(F.collect_list(F.struct("time", "bpm"))).alias("tempos"))]
    if meters is not None:
        gathered.append(meters.groupBy("song").agg(F.array_sort(F.collect_list(F.struct("time", "ts"))).alias("time_signatures")))
    return reduce(lambda a, b: a.join(b, "song", "full"), gathered)


def lyric_tracks(words: DataFrame) -> DataFrame:
    """(song, speaker, lines): each speaker's words in order."""
    return words.groupBy("song", "speaker").agg(F.array_sort(F.collect_list(F.struct("t", "d", "w"))).alias("lines"))


def merged_lyrics(words: DataFrame) -> DataFrame:
    """All speakers' words in one track, by time, then speaker."""
    order = F.array_sort(F.collect_list(F.struct("t", "speaker", "d", "w")))
    return words.groupBy("song").agg(F.transform(order, lambda s: F.struct(s["t"].alias("t"), s["d"].alias("d"), s["w"].alias("w"))).alias("lines"))


def merged_pitch(notes: DataFrame, contour: DataFrame) -> DataFrame:
    """(song, notes, contour): one voice of all speakers' notes, overlaps resolved, and each frame of the contour once."""
    from timeloom.operators import vocals

    single = vocals.monophonic(notes, ["song"]).groupBy("song").agg(F.array_sort(F.collect_list(F.struct("t", "d", "midi"))).alias("notes"))
    curve = contour.dropDuplicates(["song", "t", "hz"]).groupBy("song").agg(F.array_sort(F.collect_list(F.struct("t", "hz"))).alias("contour"))
    return single.join(curve, "song", "full")


def sounding_vocals(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("d") > 0)


def pruned(values: dict[str, Column]) -> Column:
    """A map of the values as JSON texts, without nulls, empty texts and empty arrays."""
    texts = F.create_map(*(x for n, v in values.items() for x in (F.lit(n), F.to_json(F.struct(v.alias("v"))))))
    return F.map_filter(texts, lambda _, v: ~v.isin("{}", '{"v":""}', '{"v":[]}'))


def manifests(songs: DataFrame, fields: list[str]) -> DataFrame:
    """(song, manifest): one JSON object of the fields, what is null or empty left out, names in order."""
    kept = pruned({f: F.col(f) for f in fields})
    inner = F.transform(F.array_sort(F.map_entries(kept)), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), F.regexp_extract(e["value"], r'(?s)^\{"v":(.*)\}$', 1)))
    return songs.select("song", F.concat(F.lit("{"), F.array_join(inner, ","), F.lit("}")).alias("manifest"))


def manifest_errors(songs: DataFrame, paths: list[str], capo: str | None = None) -> DataFrame:
    """Songs with the reasons why a manifest is no good: the fields whose path is invalid, a negative capo."""
    from timeloom.operators import gates

    reasons = {f"invalid_path_{p}": F.col(p).isNotNull() & ~notation.valid_path(F.col(p)) for p in paths}
    return gates.with_reasons(songs, reasons | ({"negative_capo": F.col(capo) < 0} if capo else {}))


def packages(members: DataFrame) -> DataFrame:
    """(song, content): a ZIP archive of each song's members (path, text), in order of path, with fixed dates, so equal songs give equal bytes.

    A song's members meet in one task, as its package must.
    """
    import pandas as pd

    def zipped(group: pd.DataFrame) -> pd.DataFrame:
        made = io.BytesIO()
        with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as z:
            for path, text in sorted(zip(group["path"], group["text"], strict=True)):
                z.writestr(zipfile.ZipInfo(path, (1980, 1, 1, 0, 0, 0)), text)
        return pd.DataFrame({"song": [group["song"].iat[0]], "content": [made.getvalue()]})

    return members.select("song", "path", "text").groupBy("song").applyInPandas(zipped, "song string, content binary")


def report_skeletons(reports: DataFrame, kept: dict[str, list[str]]) -> DataFrame:
    """(path, text): reports cut to the top-level fields listed for their file name; others keep only their size."""
    name = F.element_at(F.split("path", "/"), -1)

    def light(column: Column, fields: list[str]) -> Column:
        return F.to_json(F.struct(*(F.get_json_object(column, f"$.{f}").alias(f) for f in fields)))

    text: Column = F.to_json(F.struct(F.length("text").alias("bytes")))
    for file, fields in kept.items():
        text = F.when(name == file, light(F.col("text"), fields)).otherwise(text)
    return reports.select("path", text.alias("text"))
