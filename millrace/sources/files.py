"""Line files, directories, single files, HTML pages, source manifests and published artifacts."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scoring import license_of
from millrace.functions.text import title
from millrace.schema import CORPUS
from millrace.sources import paths

# Elements without text of their own interest, blocks that start a line, and elements that never close.
SKIPPED = {"script", "style", "nav", "footer", "header", "aside", "form", "noscript", "iframe", "button", "svg"}
STARTS_LINE = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "pre", "blockquote"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Names of license files, in order of preference.
LICENSE_FILES = [
    "LICENSE", "LICENSE.md", "LICENSE.txt", "LICENCE", "LICENCE.md", "LICENCE.txt", "COPYING", "LICENSE.rst", "LICENSE-2.0.txt", "LICENSE-APACHE",
    "LICENSE-MIT", "LICENSE.MIT", "LICENSE.CC0-1.0",
]


class _Prose(HTMLParser):
    """Collects headings, list entries, code and paragraphs. Void elements close themselves, so they never keep a
    skipped element open."""

    def __init__(self) -> None:
        super().__init__()
        self.parts: list[str] = []
        self.open: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in STARTS_LINE:
            self.parts.append("\n")
        if tag not in VOID:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data):
        text = " ".join(data.split())
        if not text or not SKIPPED.isdisjoint(self.open):
            return
        tag = self.open[-1] if self.open else ""
        if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
            text = "#" * int(tag[1]) + " " + text
        elif tag == "li":
            text = "- " + text
        elif tag in ("pre", "code"):
            text = f"```\n{text}\n```"
        self.parts.append(text)


def html_prose(page: str) -> str:
    """Text of an HTML page without scripts, navigation and the like."""
    parser = _Prose()
    parser.feed(page)
    parser.close()
    return "\n".join(parser.parts)


def html_to_text(c: Column) -> Column:
    """`html_prose` over a column, in Arrow batches; null stays null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: None if t is None else html_prose(t))

    return run(c)


def read_records(spark: SparkSession, path: str, schema: T.StructType = CORPUS) -> DataFrame:
    """Strict typed lines of JSON; blank lines are skipped, a malformed one fails the read, a missing path is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_records_lenient(spark: SparkSession, path: str, schema: T.StructType = CORPUS) -> tuple[DataFrame, DataFrame]:
    """Good records, and the malformed lines as `line`."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.schema(wide).option("mode", "PERMISSIVE").json(path)
    bad = F.col("_corrupt_record").isNotNull()
    lines = spark.read.text(path).filter("trim(value) <> ''")
    broken = lines.filter(F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})["_corrupt_record"].isNotNull())
    return rows.filter(~bad).drop("_corrupt_record"), broken.select(F.col("value").alias("line"))


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """Lines that hold JSON objects, as maps of strings; all other lines are skipped."""
    lines = spark.read.text(path).filter(F.col("value").rlike(r"^\s*\{.*\}\s*$"))
    return lines.select(F.from_json("value", "map<string,string>").alias("record")).filter("record is not null")


def write_records(docs: DataFrame, path: str, single_file: bool = False) -> None:
    """Lines of JSON. One file only on request, since that means one task."""
    (docs.coalesce(1) if single_file else docs).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def publish(frames: Mapping[str, DataFrame], path: str, manifest: Mapping[str, object] | None = None) -> None:
    """Write several frames as one artifact: all into a folder beside the target, which then takes its place.

    The version in force is moved aside, not deleted, until the new one stands; if a job dies in between, the next call
    (or `recover`) moves it back. `files.json` lists every file with its size and SHA-256.
    """
    if not frames:
        raise ValueError("nothing to publish")
    spark = next(iter(frames.values())).sparkSession
    fs, target, staging, previous = _places(spark, path)
    recover(spark, path)
    fs.delete(staging, True)
    for name, df in frames.items():
        write_records(df, f"{staging.toString()}/{name}.jsonl")
    if manifest is not None:
        _write_text(spark, f"{staging.toString()}/manifest.json", json.dumps(manifest, indent=2, sort_keys=True, default=str))
    listed = {r["name"]: {"bytes": r["bytes"], "sha256": r["sha256"]} for r in file_hashes(spark, staging.toString()).toLocalIterator()}
    _write_text(spark, f"{staging.toString()}/files.json", json.dumps(listed, indent=2, sort_keys=True))
    if fs.exists(target) and not fs.rename(target, previous):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(staging, target):
        recover(spark, path)
        raise OSError(f"could not publish {path}")
    fs.delete(previous, True)


def _places(spark: SparkSession, path: str):
    root = path.rstrip("/")
    target, staging, previous = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{root}.staging", f"{root}.previous"))
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target, staging, previous


def recover(spark: SparkSession, path: str) -> bool:
    """Whether a version that an interrupted `publish` had moved aside was put back in force."""
    fs, target, _, previous = _places(spark, path)
    if not fs.exists(previous):
        return False
    if fs.exists(target):
        fs.delete(previous, True)
        return False
    return bool(fs.rename(previous, target))


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(name, bytes, sha256) of every file of an artifact, hashed where it lies; marks of finished writes and the list of
    hashes itself are left out."""
    root = path.rstrip("/").split(":")[-1].lstrip("/")
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_replace(F.col("path"), f"^.*?{re.escape(root)}/", "")
    return rows.select(name.alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).filter("not name rlike '(^|/)(_SUCCESS|files[.]json|[.].*[.]crc)$'")


def verify_artifact(spark: SparkSession, path: str) -> None:
    """Compare a published artifact with its list of hashes; raises ValueError naming the files that differ, are missing or
    were added."""
    listed = json.loads("\n".join(r[0] for r in spark.read.text(f"{path.rstrip('/')}/files.json").toLocalIterator()))
    want = spark.createDataFrame([(k, v["sha256"]) for k, v in listed.items()], "name string, want string")
    bad = file_hashes(spark, path).join(want, "name", "full").filter("not (sha256 <=> want)").select("name").limit(20)
    names = [r["name"] for r in bad.collect()]  # at most twenty are named
    if names:
        raise ValueError(f"artifact {path} was changed: {', '.join(sorted(names))}")


def write_partitioned(docs: DataFrame, path: str, by: str = "split") -> None:
    """One folder of JSON lines per value of a column."""
    docs.write.mode("overwrite").partitionBy(by).json(path)


@dataclass(frozen=True)
class Source:
    """One configured source."""

    id: str
    name: str = ""
    category: str = "software_architecture"
    enabled: bool = True
    type: str = "local_directory"
    path: str | None = None
    url: str | None = None
    license_id: str | None = None
    language: str = "en"
    include_patterns: tuple[str, ...] = ()
    exclude_patterns: tuple[str, ...] = ()
    allowed_content_types: tuple[str, ...] = ()
    parser: str | None = None
    source_token_cap: int | None = None
    source_priority: float = 1.0
    license_rules: tuple[dict, ...] = ()
    strip_section_patterns: tuple[str, ...] = ()
    section_category_rules: Mapping[str, str] = field(default_factory=dict)
    metadata: Mapping[str, str] = field(default_factory=dict)


def load_manifest(path: str) -> list[Source]:
    """Sources of a YAML manifest; none if it has no `sources`. A missing file is an error."""
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f) or {}
    out = []
    for s in data.get("sources") or []:
        known = {k: v for k, v in s.items() if k in Source.__dataclass_fields__ and v is not None}
        known = {k: tuple(v) if isinstance(v, list) else v for k, v in known.items()}
        policy = s.get("license_policy") or {}
        rules = tuple(policy.get("rules") or ()) if policy.get("mode") == "path_scoped" else ()
        out.append(Source(**{**known, "name": s.get("name", s["id"]), "category": s.get("category_hint", s.get("category", "software_architecture")), "license_rules": rules}))
    return out


def resolve(path: str) -> str:
    """Path with its environment variables filled in, relative ones under the working folder."""
    return os.path.abspath(os.path.expandvars(path))


def _files(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    prefix = resolve(root).rstrip("/") + "/"
    full = F.regexp_replace(F.col("path"), "^[a-z0-9]+:/*(?=/)", "")
    return files.withColumn("relative_path", F.when(full.startswith(prefix), F.substring(full, len(prefix) + 1, 1 << 20)).otherwise(F.substring_index(full, "/", -1)))


def _document(source: Source, text: Column, key: Column) -> list[Column]:
    return [
        F.substring(F.sha2(F.concat_ws(":", F.lit(source.id), key), 256), 1, 16).alias("id"), F.lit(source.id).alias("source_id"), F.lit(source.category).alias("category"),
        F.lit(source.language).alias("language"), F.col("relative_path"), title(text, paths.stem(F.col("relative_path"))).alias("title"), text.alias("text"),
    ]


def read_directory(spark: SparkSession, source: Source) -> DataFrame:
    """Documents of a folder: files that the patterns and content types allow, in any depth, blank ones left out.

    The listing and the reading are distributed; the content is read only for allowed files. HTML becomes prose,
    other files are UTF-8 with bad bytes replaced. Files that a path rule excludes from training are left out.
    """
    if not source.path:
        raise ValueError(f"source {source.id!r} needs a path")
    files = _files(spark, resolve(source.path)).filter(paths.allowed(F.col("relative_path"), source.include_patterns, source.exclude_patterns))
    if source.allowed_content_types:
        files = files.filter(F.coalesce(paths.content_type(F.col("relative_path")).isin(*[t.lower() for t in source.allowed_content_types]), F.lit(False)))
    raw = _decode(F.col("content"))
    page = F.lit(source.parser == "html") | paths.suffix(F.col("relative_path")).isin("html", "htm")
    text = F.when(page, html_to_text(F.when(page, raw))).otherwise(raw)
    docs = files.withColumn("_text", text).filter(F.trim(F.regexp_replace("_text", r"\s+", " ")) != "")
    if source.license_rules:
        lic = paths.scoped_license(F.col("relative_path"), source.license_rules)
        docs = docs.withColumn("_license", lic).filter("_license.training_enabled")
        license_id = F.col("_license.license_id")
    else:
        license_id = F.lit(source.license_id).cast("string")
    return docs.select(*_document(source, F.col("_text"), F.col("relative_path")), license_id.alias("license_id"))


def _decode(content: Column) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else bytes(b).decode("utf-8", errors="replace"))

    return run(content)


def read_file(spark: SparkSession, source: Source) -> DataFrame:
    """The single document of a file; its id depends on the file name only. HTML, by its name or the source's parser,
    becomes prose."""
    if not source.path:
        raise ValueError(f"source {source.id!r} needs a path")
    rows = spark.read.text(resolve(source.path), wholetext=True).withColumn("relative_path", F.lit(os.path.basename(source.path)))
    if source.parser == "html" or source.path.lower().endswith((".html", ".htm")):
        rows = rows.withColumn("value", html_to_text(F.col("value")))
    return rows.filter("trim(value) <> ''").select(*_document(source, F.col("value"), F.col("relative_path")), F.lit(source.license_id).cast("string").alias("license_id"))


def commit_of(root: str) -> str:
    """Commit that a cloned folder stands at, read from its files; `unknown` if there is none."""
    git = os.path.join(resolve(root), ".git")
    try:
        with open(os.path.join(git, "HEAD"), encoding="utf-8") as f:
            head = f.read().strip()
        if not head.startswith("ref:"):
            return head or "unknown"
        name = head.removeprefix("ref:").strip()
        loose = os.path.join(git, *name.split("/"))
        if os.path.isfile(loose):
            with open(loose, encoding="utf-8") as f:
                return f.read().strip() or "unknown"
        with open(os.path.join(git, "packed-refs"), encoding="utf-8") as f:
            return next((line.split()[0] for line in f if line.split()[1:] == [name]), "unknown")
    except OSError:
        return "unknown"


def read_repository(spark: SparkSession, source: Source) -> DataFrame:
    """Documents of a cloned repository, `source.path`, if its license file names the declared license; else none.

    The id holds the commit, the address is the file's page at that commit, and the license is the verified one.
    """
    docs = read_directory(spark, source)
    checked = verify_license(spark, source.path, source.license_id)
    if not checked["valid"]:
        docs = docs.limit(0)
    commit, base = commit_of(source.path), (source.url or "").removesuffix(".git")
    page = F.concat(F.lit(f"{base}/blob/{commit}/" if "github.com" in base else f"{base}#"), F.col("relative_path"))
    key = F.sha2(F.concat_ws(":", F.lit(source.id), F.lit(commit), F.col("relative_path")), 256)
    license_id = F.col("license_id") if source.license_rules else F.lit(checked["verified"]).cast("string")
    return docs.withColumn("id", F.substring(key, 1, 16)).withColumn("license_id", license_id).withColumn("source_url", page)


def read_fetched(spark: SparkSession, source: Source) -> DataFrame:
    """Documents of a page source: `source.path` is a table of fetched pages(url, html), of which those of `source.url`
    are taken. Nothing is fetched here; a source without a license gives none."""
    if not source.path or not source.url:
        raise ValueError(f"source {source.id!r} needs a url and the table of its fetched pages as path")
    pages = spark.read.parquet(resolve(source.path)).filter(F.col("url").startswith(source.url))
    return read_pages(pages, source).withColumn("source_url", F.col("relative_path"))


def read_pages(pages: DataFrame, source: Source) -> DataFrame:
    """Documents of fetched pages(url, html) of a source that states a license; nothing without one."""
    text = html_to_text(F.col("html"))
    rows = pages.withColumn("_text", text).filter(F.trim(F.regexp_replace("_text", r"\s+", " ")) != "").withColumn("relative_path", F.col("url"))
    docs = rows.select(*_document(source, F.col("_text"), F.col("url")), F.lit(source.license_id).cast("string").alias("license_id"))
    return docs if source.enabled and source.license_id else docs.limit(0)


#: Reader of every source type.
READERS = {"local_directory": read_directory, "markdown_directory": read_directory, "git_repository": read_repository, "http_documentation": read_fetched, "local_file": read_file}


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    if source.type.lower() not in READERS:
        raise ValueError(f"unsupported source type {source.type!r}")
    return READERS[source.type.lower()](spark, source)


def read_sources(spark: SparkSession, sources: Sequence[Source]) -> DataFrame:
    """Documents of all enabled sources, with `ord` giving the order of sources and paths."""
    frames = [read_source(spark, s).withColumn("_source", F.lit(i)) for i, s in enumerate(sources) if s.enabled]
    if not frames:
        return spark.createDataFrame([], CORPUS).withColumn("ord", F.lit(0).cast("long"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.withColumn("ord", F.struct("_source", "relative_path")).drop("_source")


def dry_run(spark: SparkSession, sources: Sequence[Source], first: int = 10) -> DataFrame:
    """Per source, disabled ones too: the number of files that would be read and the first of their paths. Only listings
    are read."""
    rows = [(s.id, s.type, s.category, s.enabled, s.license_id) for s in sources]
    out = spark.createDataFrame(rows, "source_id string, type string, category string, enabled boolean, license_id string")
    frames = []
    for s in sources:
        if s.enabled and s.path and os.path.isdir(resolve(s.path)):
            f = _files(spark, resolve(s.path)).filter(paths.allowed(F.col("relative_path"), s.include_patterns, s.exclude_patterns)).select("relative_path")
            head = f.orderBy("relative_path").limit(first).agg(F.array_sort(F.collect_list("relative_path")).alias("candidate_files"))
            frames.append(f.agg(F.count("*").alias("candidates")).crossJoin(head).select(F.lit(s.id).alias("source_id"), "candidates", "candidate_files"))  # one row each
        elif s.enabled and s.path and os.path.isfile(resolve(s.path)) and s.type == "local_file":
            frames.append(spark.createDataFrame([(s.id, 1, [os.path.basename(s.path)])], "source_id string, candidates long, candidate_files array<string>"))
    listed = spark.createDataFrame([], "source_id string, candidates long, candidate_files array<string>")
    for f in frames:
        listed = listed.unionByName(f)
    out = out.join(F.broadcast(listed), "source_id", "left")  # one row per source of the manifest
    return out.withColumn("candidates", F.coalesce("candidates", F.lit(0))).withColumn("candidate_files", F.coalesce("candidate_files", F.array().cast("array<string>")))


def volume(listed: DataFrame) -> DataFrame:
    """Per source of listed(source_id, length): files, bytes and a token estimate of a quarter of the bytes."""
    return listed.groupBy("source_id").agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).withColumn("estimated_tokens", F.floor(F.col("bytes") / 4))


def inventory(spark: SparkSession, sources: Sequence[Source]) -> DataFrame:
    """Per source: allowed files, bytes and a token estimate of a quarter of the bytes; contents are not read."""
    out = spark.createDataFrame([(s.id, None) for s in sources], "source_id string, length long")
    for s in sources:
        if s.path and os.path.isdir(resolve(s.path)):
            f = _files(spark, resolve(s.path)).filter(paths.allowed(F.col("relative_path"), s.include_patterns, s.exclude_patterns))
            out = out.unionByName(f.select(F.lit(s.id).alias("source_id"), "length"))
    found = volume(out.filter("length is not null"))
    every = spark.createDataFrame([(s.id,) for s in sources], "source_id string")
    return every.join(found, "source_id", "left").fillna(0)


def verify_license(spark: SparkSession, root: str, declared: str | None) -> dict[str, object]:
    """Whether the license file of a repository names the declared license: probes the file names in order."""
    for name in LICENSE_FILES:
        file = os.path.join(resolve(root), name)
        if os.path.isfile(file):
            row = spark.read.text(file, wholetext=True).select(license_of(F.col("value")).alias("found")).first()
            found = row["found"] if row else None
            error = (
                "undeclared" if not declared else "unknown_license" if found is None else "mismatch" if declared.strip().upper() != found.upper() else None
            )
            return {"valid": error is None, "declared": declared, "detected": found, "verified": None if error else found, "file": name, "error": error}
    return {"valid": False, "declared": declared, "detected": None, "verified": None, "file": None, "error": "no_license_file"}


def write_packed(sequences: DataFrame, path: str) -> None:
    """Packed sequences as an artifact: lines of JSON, with their statistics and a hash of their contents as manifest."""
    from millrace.operators.analytics import set_hash
    from millrace.operators.sequence import packing_statistics

    totals = packing_statistics(sequences).first().asDict()
    content = sequences.select(F.sha2(F.concat_ws(":", F.col("sequence").cast("string"), F.array_join("input_ids", ","), F.array_join("labels", ",")), 256).alias("h"))
    publish({"sequences": sequences}, path, {"statistics": totals, "fingerprint": set_hash(content).first()[0]})


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """Packed sequences of an artifact; an empty one is an error."""
    rows = spark.read.schema("sequence long, input_ids array<bigint>, labels array<bigint>, attention_mask array<bigint>").json(f"{path.rstrip('/')}/sequences.jsonl")
    if rows.isEmpty():
        raise ValueError(f"no packed sequences in {path}")
    return rows


def write_report(tables: Mapping[str, DataFrame], path: str, title: str = "Report", most: int = 200) -> None:
    """Small tables as one Markdown file, a section each; of a longer table the first `most` rows are shown, and the
    number of all is told."""
    spark = next(iter(tables.values())).sparkSession
    out = [f"# {title}"]
    for name, df in tables.items():
        rows = df.limit(most + 1).collect()  # at most `most` + 1 rows
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|").replace("\n", " ") for v in r) + " |" for r in rows[:most]]
        if len(rows) > most:
            out += ["", f"{df.count()} rows in all."]
    _write_text(spark, path, "\n".join(out) + "\n")


def ledger_decisions(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a ledger counted by decision."""
    return spark.read.schema("decision string").json(path).groupBy("decision").agg(F.count("*").alias("entries"))
