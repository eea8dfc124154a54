"""Directory layouts of speech corpora as tables of source items."""

from __future__ import annotations

import codecs
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Which files are audio, which directories mean which class, which columns hold what.
SUFFIXES = ("wav", "flac", "mp3", "m4a", "ogg", "opus", "aac", "wma")
REAL_DIRS = ("real", "bonafide", "genuine", "human", "that", "goc")
FAKE_DIRS = ("fake", "spoof", "synthetic", "tts", "deepfake", "gia", "clone")
TSVS = ("validated.tsv", "train.tsv", "other.tsv", "dev.tsv", "test.tsv")
AUDIO_COLUMNS = ("audio", "wav", "speech", "file", "path")
TEXT_COLUMNS = ("sentence", "text", "transcription", "transcript", "normalized_text")
SPEAKER_COLUMNS = ("speaker", "speaker_id", "client_id", "spk", "spk_id", "speaker_name")
ARCHIVES = ("zip", "tar", "gz", "tgz", "bz2", "xz", "7z", "rar")
TABLES = ("parquet", "arrow", "jsonl", "json", "csv", "tsv")
METADATA, PROMPTS = ("metadata.csv", "metadata.txt", "metadata.tsv"), ("prompts.txt", "transcript.txt", "transcripts.txt")
# First bytes of formats, by their public descriptions: what kind of file it is, where they stand, the bytes.
SIGNATURES = (
    ("archive", 0, b"PK\x03\x04"), ("archive", 0, b"\x1f\x8b"), ("archive", 0, b"BZh"), ("archive", 0, b"\xfd7zXZ\x00"),
    ("archive", 0, b"7z\xbc\xaf\x27\x1c"), ("archive", 0, b"Rar!\x1a\x07"), ("archive", 0, b"\x28\xb5\x2f\xfd"), ("archive", 257, b"ustar"),
    ("table", 0, b"PAR1"), ("table", 0, b"ARROW1"), ("table", 0, b"\xff\xff\xff\xff"), ("table", 0, b"ORC"), ("table", 0, b"Obj\x01"),
    ("audio", 0, b"RIFF"), ("audio", 0, b"fLaC"), ("audio", 0, b"OggS"), ("audio", 0, b"ID3"),
)
# End of fixed values.

#: Bytes at the beginning of a file that are looked at.
HEAD = 512
#: Sentences to speak where a corpus has no transcripts.
SENTENCES = (
    "Sáng nay trời trong và gió nhẹ thổi qua dòng sông.",
    "Chuyến tàu cuối cùng rời ga lúc mười giờ tối hôm qua.",
    "Mẹ tôi thường nấu canh chua vào những ngày cuối tuần.",
    "Cuốn sách trên bàn kể về một ngôi làng ven biển.",
    "Chúng tôi hẹn gặp nhau trước cổng trường vào chiều thứ sáu.",
    "Đàn chim bay về phương nam khi mùa đông sắp đến.",
    "Ông nội trồng một hàng cau phía sau ngôi nhà cũ.",
    "Cửa hàng đầu phố mở cửa từ sáu giờ sáng mỗi ngày.",
    "Cơn mưa rào bất chợt làm ướt hết quần áo đang phơi.",
    "Bác sĩ dặn tôi uống thuốc sau bữa ăn ba lần một ngày.",
    "Lớp học vẽ bắt đầu muộn hơn nửa tiếng so với lịch.",
    "Con đường đất dẫn lên đồi phủ đầy hoa dại màu tím.",
    "Xe buýt số bảy dừng ngay trước cổng bệnh viện thành phố.",
    "Anh ấy học chơi đàn bầu từ khi còn rất nhỏ.",
    "Phiên chợ vùng cao chỉ họp vào ngày chủ nhật.",
    "Em gái tôi thích đọc truyện cổ tích trước khi ngủ.",
    "Nhà máy mới tuyển thêm hai trăm công nhân trong năm nay.",
    "Trận bóng kết thúc với tỉ số hòa sau hai hiệp đấu.",
    "Người thợ mộc sửa lại chiếc ghế gãy chân cho bà cụ.",
    "Ngày mai thời tiết ở miền trung sẽ nắng nóng trở lại.",
)

MOST_CHILDREN, MOST_DEPTH = 24, 4


def listing(spark: SparkSession, root: str) -> DataFrame:
    """path, rel (below root), name, stem, suffix, length of every file whose path has no hidden part. Contents aren't
    read unless a later step selects them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    rel = F.substring_index(F.col("path"), f"{base}/", -1)
    name = F.element_at(F.split(rel, "/"), -1)
    out = files.select("path", rel.alias("rel"), name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("suffix"), "length", "content")
    return out.where(~F.col("rel").rlike(r"(^|/)\."))


def audio_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    return listing(spark, root).where(F.col("suffix").isin(*suffixes))


def _lines(spark: SparkSession, files: DataFrame) -> DataFrame:
    """path, at, line of small text files."""
    text = F.decode(F.col("content"), "UTF-8")
    return files.select("path", "rel", "name", F.posexplode(F.split(text, r"\r?\n")).alias("at", "line"))


def transcripts(spark: SparkSession, root: str) -> DataFrame:
    """stem, text: from metadata files first, then prompt files, then a text file beside the clip; the first line of
    several."""
    files = listing(spark, root)
    top = files.where(~F.col("rel").contains("/"))
    rank = lambda names: F.array_position(F.array(*(F.lit(n) for n in names)), F.col("name"))
    meta = _lines(spark, top.where(F.col("name").isin(*METADATA))).where("trim(line) <> ''")
    mark = F.when(F.col("line").contains("|"), r"\|").when(F.col("line").contains("\t"), "\t").otherwise(",")
    fields = F.transform(F.split("line", mark), F.trim)
    from_meta = meta.withColumn("f", fields).where("size(f) >= 2").select(F.lit(1).alias("priority"), rank(METADATA).alias("file"), "at", F.col("f")[0].alias("id"), F.element_at("f", -1).alias("text"))
    prompt = _lines(spark, top.where(F.col("name").isin(*PROMPTS))).withColumn("bare", F.trim("line"))
    from_prompts = prompt.where(F.col("bare").rlike(r"\S\s+\S")).select(F.lit(2), rank(PROMPTS), "at", F.regexp_extract("bare", r"^(\S+)", 1), F.trim(F.regexp_replace("bare", r"^\S+\s+", "")))
    side = files.where(F.col("suffix").isin("txt", "lab") & ~F.col("name").isin(*PROMPTS, *METADATA))
    from_side = side.select(F.lit(3), F.when(F.col("suffix") == "txt", 1).otherwise(2), F.lit(0), "stem", F.trim(F.decode("content", "UTF-8")))
    every = from_meta.union(from_prompts).union(from_side)
    stem = F.regexp_replace(F.element_at(F.split("id", "/"), -1), r"\.[^.]*$", "")
    first = Window.partitionBy("stem").orderBy("priority", "file", "at", "text")
    return every.select(stem.alias("stem"), "text", "priority", "file", "at").withColumn("n", F.row_number().over(first)).where("n = 1").select("stem", "text")


def _items(files: DataFrame, speaker: Column, text: Column, split: Column | None = None, label: Column | None = None, generator: Column | None = None) -> DataFrame:
    none = F.lit("")
    return files.select(F.col("rel").alias("key"), "path", "content", speaker.alias("speaker"), F.coalesce(text, none).alias("text"), (split if split is not None else none).alias("split_hint"), (label if label is not None else F.lit("real")).alias("label"), (generator if generator is not None else none).alias("generator"))


def vivos(spark: SparkSession, root: str) -> DataFrame:
    """<split>/waves/<speaker>/<clip>.wav with <split>/prompts.txt of "<clip> <text>" lines."""
    files = audio_files(spark, root).where(F.col("rel").rlike(r"^[^/]+/waves/[^/]+/[^/]+$")).withColumn("dir", F.split("rel", "/")[0])
    lines = _lines(spark, listing(spark, root).where(F.col("rel").rlike(r"^[^/]+/prompts\.txt$")))
    bare = F.trim("line")
    prompts = lines.where(bare != "").select(F.split("rel", "/")[0].alias("dir"), F.regexp_extract(bare, r"^(\S+)", 1).alias("stem"), F.trim(F.regexp_replace(bare, r"^\S+", "")).alias("said"), "at")
    prompts = prompts.groupBy("dir", "stem").agg(F.max_by("said", "at").alias("said"))
    hint = F.when(F.lower("dir").isin("test", "dev"), "test").otherwise("train")
    return _items(files.join(prompts, ["dir", "stem"], "left"), F.split("rel", "/")[2], F.col("said"), hint)


def common_voice(spark: SparkSession, root: str) -> DataFrame:
    """clips/ and a TSV of client_id, path, sentence: the first that there is in a fixed order, else the first by name.
    A clip is found by its name, else by its stem."""
    files = audio_files(spark, root)
    tsvs = sorted(r.name for r in listing(spark, root).where("suffix = 'tsv' and rel not like '%/%'").select("name").collect())
    if not tsvs:
        raise FileNotFoundError(f"no TSV in {root}")
    rows = spark.read.option("header", True).option("sep", "\t").option("quote", "").csv(f"{root}/{next((t for t in TSVS if t in tsvs), tsvs[0])}")
    rows = rows.select(F.col("path").alias("clip"), "sentence", "client_id").withColumn("clip_stem", F.regexp_replace("clip", r"\.[^.]*$", ""))
    exact = files.select(F.col("name").alias("clip"), F.col("path").alias("by_name")).groupBy("clip").agg(F.min("by_name").alias("by_name"))
    loose = files.select(F.col("stem").alias("clip_stem"), F.col("path").alias("by_stem")).groupBy("clip_stem").agg(F.min("by_stem").alias("by_stem"))
    found = rows.join(exact, "clip", "left").join(loose, "clip_stem", "left").withColumn("path", F.coalesce("by_name", "by_stem")).where("path is not null")
    speaker = F.coalesce(F.nullif(F.substring("client_id", 1, 16), F.lit("")), F.lit("cv-unknown"))
    return _items(files.join(found.select("path", "sentence", "client_id"), "path"), speaker, F.col("sentence"))


def folder(spark: SparkSession, root: str) -> DataFrame:
    """Any directory: the nearest one above a clip is its speaker."""
    files = audio_files(spark, root).join(transcripts(spark, root), "stem", "left")
    dirs = F.split("rel", "/")
    return _items(files, F.when(F.size(dirs) > 1, F.element_at(dirs, -2)).otherwise("unknown"), F.col("text"))


def labelled_folder(spark: SparkSession, root: str) -> DataFrame:
    """real/... and fake/<engine>/... by any of their synonyms. A fake's speaker is its engine's directory."""
    files = audio_files(spark, root).join(transcripts(spark, root), "stem", "left")
    dirs = F.split("rel", "/")
    fake = F.lower(dirs[0]).isin(*FAKE_DIRS)
    second = F.when(F.size(dirs) > 2, dirs[1]).otherwise("unknown")
    speaker = F.when(fake, second).when(F.size(dirs) > 2, F.element_at(dirs, -2)).otherwise("unknown")
    return _items(files.where(fake | F.lower(dirs[0]).isin(*REAL_DIRS)), speaker, F.col("text"), None, F.when(fake, "fake").otherwise("real"), F.when(fake, second).otherwise(""))


def resolve(columns: list[str], candidates: tuple[str, ...]) -> str | None:
    """Of the columns that are candidates, in any case of letters, the one that stands first among the candidates."""
    rank = {c: k for k, c in enumerate(candidates)}
    return min((c for c in columns if c.lower() in rank), key=lambda c: rank[c.lower()], default=None)


def table(df: DataFrame, name: str) -> DataFrame:
    """Items of any table by the names of its columns. Its audio is a struct of bytes and path, or of array and
    sampling_rate, or a path."""
    audio, text, speaker = (resolve(df.columns, c) for c in (AUDIO_COLUMNS, TEXT_COLUMNS, SPEAKER_COLUMNS))
    if audio is None:
        raise ValueError(f"no audio column among {df.columns}")
    kind = df.schema[audio].dataType
    fields = set(kind.fieldNames()) if hasattr(kind, "fieldNames") else set()
    of = lambda f, t: F.col(f"`{audio}`.{f}").cast(t) if f in fields else F.lit(None).cast(t)
    path = of("path", "string") if fields else F.col(audio).cast("string")
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c else F.lit(d) for c, d in ((text, ""), (speaker, "hf-unknown"))]
    key = F.coalesce(path, F.concat(F.lit(f"{name}#"), F.xxhash64(*said, of("bytes", "binary")).cast("string")))
    return df.select(key.alias("key"), path.alias("path"), of("bytes", "binary").alias("content"), of("array", "array<float>").alias("signal"), of("sampling_rate", "int").alias("sample_rate"), said[1].alias("speaker"), said[0].alias("text"))


def sentences(spark: SparkSession, path: str | None = None) -> DataFrame:
    """text: the lines of a file that aren't blank; without a file, the built-in sentences."""
    if path is None:
        return spark.createDataFrame([(s,) for s in SENTENCES], "text string")
    return spark.read.text(path).select(F.trim("value").alias("text")).where("text <> ''")


Adapter = Callable[[SparkSession, str], DataFrame]
ADAPTERS: dict[str, Adapter] = {"vivos": vivos, "common_voice": common_voice, "labeled_folder": labelled_folder, "folder": folder}


def register(name: str, fn: Adapter) -> None:
    if name in ADAPTERS:
        raise ValueError(f"{name} exists already")
    ADAPTERS[name] = fn


def detect(spark: SparkSession, roots: str | list[str], depth: int = MOST_DEPTH) -> tuple[str, float, str]:
    """(adapter, score, directory) that fits best among all directories of up to `depth` levels below the roots, not
    below one with more than 24 directories; of equal scores the shallowest. Scores are sums over the listing."""
    best = None
    for root in [roots] if isinstance(roots, str) else roots:
        try:
            files = listing(spark, root).select("rel", "name", "suffix")
        except AnalysisException:
            continue
        parts = F.split("rel", "/")
        levels = F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(depth)))
        at = files.select("name", "suffix", F.explode(F.transform(levels, lambda k: F.struct(F.array_join(F.slice(parts, 1, k), "/").alias("dir"), F.slice(parts, k + 1, F.size(parts)).alias("below")))).alias("d")).select("name", "suffix", "d.dir", "d.below")
        crowded = at.where("size(below) > 1").groupBy("dir").agg(F.count_distinct(F.get("below", F.lit(0))).alias("n")).where(F.col("n") > MOST_CHILDREN)
        wide = [r.dir for r in crowded.select("dir").collect()]
        first, last = F.lower(F.get("below", F.lit(0))), F.size("below")
        has = lambda c: F.max(F.when(c, 1).otherwise(0))
        facts = at.groupBy("dir").agg(
            *(has((F.get("below", F.lit(0)) == s) & (F.get("below", F.lit(1)) == "prompts.txt") & (last == 2)).alias(f"p_{s}") for s in ("train", "test")),
            *(has((F.get("below", F.lit(0)) == s) & (F.get("below", F.lit(1)) == "waves") & (last > 2)).alias(f"w_{s}") for s in ("train", "test")),
            has((F.get("below", F.lit(1)) == "waves") & F.get("below", F.lit(2)).startswith("VIVOS")).alias("spk"),
            has((F.get("below", F.lit(0)) == "clips") & (last > 1)).alias("clips"), has(F.col("name").isin(*TSVS) & (last == 1)).alias("tsv"),
            has(first.isin(*REAL_DIRS) & (last > 1)).alias("real"), has(first.isin(*FAKE_DIRS) & (last > 1)).alias("fake"), has(F.col("suffix").isin(*SUFFIXES)).alias("audio"),
        )
        scores = F.array(
            F.struct(F.least(F.lit(1.0), 0.4 * (F.col("p_train") + F.col("p_test")) + 0.1 * (F.col("w_train") + F.col("w_test")) + 0.2 * F.col("spk")).alias("s"), F.lit("vivos").alias("a")),
            *(F.struct(v.alias("s"), F.lit(a).alias("a")) for v, a in ((0.5 * F.col("clips") + 0.4 * F.col("tsv"), "common_voice"), (0.9 * F.col("real") * F.col("fake"), "labeled_folder"), (0.15 * F.col("audio"), "folder"))),
        )
        level = F.when(F.col("dir") == "", 0).otherwise(F.size(F.split("dir", "/")))
        inside = ~F.exists(F.array(*(F.lit(w) for w in wide)), lambda w: (w == "") & (F.col("dir") != "") | F.col("dir").startswith(F.concat(w, F.lit("/")))) if wide else F.lit(True)
        row = facts.where(inside).select("dir", level.alias("level"), F.array_max(scores).alias("b")).orderBy(F.desc("b.s"), "level", "dir").head()
        if row and row.b.s > 0 and (best is None or row.b.s > best[1]):
            best = (row.b.a, row.b.s, f"{root.rstrip('/')}/{row.dir}".rstrip("/"))
    if best is None:
        raise FileNotFoundError(f"no adapter fits {roots}")
    return best


def describe(spark: SparkSession, root: str, also: tuple[str, ...] = ()) -> DataFrame:
    """suffix, n, samples: the eight most frequent suffixes, and those of `also` that there are, with five of their files
    each. All files count."""
    files = listing(spark, root).select("suffix", "rel")
    counts = files.groupBy("suffix").agg(F.count("*").alias("n"))
    chosen = counts.orderBy(F.desc("n"), "suffix").limit(8)
    chosen = chosen.union(counts.where(F.col("suffix").isin(*also))).distinct() if also else chosen
    few = files.join(chosen.select("suffix"), "suffix").withColumn("at_", F.row_number().over(Window.partitionBy("suffix").orderBy("rel"))).where("at_ <= 5")
    return chosen.join(few.groupBy("suffix").agg(F.sort_array(F.collect_list("rel")).alias("samples")), "suffix").orderBy(F.desc("n"), "suffix")


def heads(spark: SparkSession, paths: list[str], n: int = HEAD) -> list[bytes]:
    """The first n bytes of a few files, through the file system that each path names; no more of them is read."""
    conf, out = spark._jsc.hadoopConfiguration(), []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        stream = path.getFileSystem(conf).open(path)
        try:
            out.append(bytes(stream.readNBytes(n)))
        finally:
            stream.close()
    return out


def kind_of(head: bytes) -> str:
    """archive, table, audio, text, empty or other, by a file's first bytes. Text is a table if it begins as JSON, or if
    its first two lines have as many tabs, or commas, and one at least."""
    if not head:
        return "empty"
    for kind, at, signature in SIGNATURES:
        if head.startswith(signature, at):
            return kind
    try:
        text = codecs.getincrementaldecoder("utf-8")().decode(head)
    except UnicodeDecodeError:
        return "other"
    if "\0" in text:
        return "other"
    lines = [line for line in text.splitlines() if line.strip()][:2]
    if not lines:
        return "text"
    json = lines[0].lstrip()[:1] in ("{", "[")
    marked = len(lines) == 2 and any(lines[0].count(m) == lines[1].count(m) > 0 for m in "\t,")
    return "table" if json or marked else "text"


def profile(spark: SparkSession, root: str) -> DataFrame:
    """describe() with kinds: what the samples of each suffix are by their first bytes, whatever they are called. Suffixes
    of archives and tables are among them however rare. A few files a suffix are opened, and only their heads read."""
    found = describe(spark, root, ARCHIVES + TABLES).collect()  # 8 suffixes and the known ones at most
    base = root.rstrip("/")
    rows = [(r.suffix, r.n, r.samples, sorted({kind_of(h) for h in heads(spark, [f"{base}/{s}" for s in r.samples])})) for r in found]
    return spark.createDataFrame(rows, "suffix string, n bigint, samples array<string>, kinds array<string>")


def hints(found: DataFrame) -> list[str]:
    """What to do with a directory that no adapter fits, from its profile(): 'empty' (no files), 'no_audio' (no known
    suffix of audio), 'archives' (unpack them first), 'tables' (read them by table())."""
    rows = found.collect()
    has = lambda kind, suffixes: any(kind in r.kinds or r.suffix in suffixes for r in rows)
    told = {"empty": not rows, "no_audio": not has("audio", SUFFIXES), "archives": has("archive", ARCHIVES), "tables": has("table", TABLES)}
    return [k for k, v in told.items() if v]
