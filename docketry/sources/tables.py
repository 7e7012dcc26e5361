"""Readers and writers (inventory SRC, SNK).  Parquet is the store; CSV and JSON are for exchange."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_spaces, empty_to_null, fold, let, repair_payload, safe_name

#: A captured document: text, tables, address, title and how it was read.
SNAPSHOT = "captured_at string, document_type string, requested_type string, processo string, documento string, snapshot struct<text:string,tables:array<struct<rows:array<array<string>>>>,url:string,title:string,extraction_mode:string>, collection struct<found:boolean,found_in:string,search_term:string,results_count:int,chosen_documento:string,selection_reason:string,selection_detail:string,extraction_error:string>, prazos struct<status:string,inicio_data:string,inicio_raw:string,termino_data:string,termino_raw:string>"


#: Least tasks a core over which costly rows are spread.
TASKS = 4


def spread(df: DataFrame) -> DataFrame:
    """df's rows dealt evenly over TASKS tasks a core, or as many as shuffles have if that is more.  For narrow rows before
    costly expressions: a file is cut at its row groups, so a small or compact one would be the work of a task or two."""
    spark = df.sparkSession
    return df.repartition(max(TASKS * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _there(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; that setting is made here only where it is unset in local mode (tests)."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="docketry-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def read_csv(spark: SparkSession, path: str, columns: list[str], collapse: bool = False) -> DataFrame:
    """SRC1, SRC2 (collapse): all text, the wanted columns in order; absent columns are empty, an absent file is an
    empty frame.  Adds row_idx, the order of reading."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if not _there(spark, path):
        return spark.createDataFrame([], schema).withColumn("row_idx", F.lit(0).cast("long"))
    df = spark.read.options(header=True, multiLine=True, escape='"', encoding="UTF-8").csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns]).withColumn("row_idx", F.monotonically_increasing_id())
    have = set(df.columns)
    cell = lambda c: F.coalesce(clean_spaces(F.col(c)) if collapse else F.col(c), F.lit("")) if c in have else F.lit("")
    return df.select(*[cell(c).alias(c) for c in columns], "row_idx")


def read_snapshots(spark: SparkSession, path: str, schema: str = SNAPSHOT, corrupt: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """SRC3: one JSON object a file, with json_path, and the files that hold none.  `payload` is the whole object as it came
    (VARIANT), with the keys that the schema doesn't name.  See landing() for the repair."""
    return snapshots_of(spark.read.text(path, wholetext=True).withColumn("json_path", F.col("_metadata.file_path")), schema, corrupt)


def snapshots_of(texts: DataFrame, schema: str = SNAPSHOT, corrupt: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """read_snapshots over rows (json_path, value) that are there already."""
    df = texts.select("json_path", "value", _parsed(F.col("value"), schema, corrupt).alias("r"))
    df = df.select("json_path", "value", F.coalesce(f"r.{corrupt}", F.when(F.col("r").isNull(), F.lit(""))).alias(corrupt), "r")
    good = df.where(F.col(corrupt).isNull()).select("r.*", F.try_parse_json("value").alias("payload"), "json_path").drop(corrupt)
    return good, df.where(F.col(corrupt).isNotNull()).select("json_path", corrupt)


def _parsed(c: Column, schema: str, corrupt: str) -> Column:
    """A JSON text as a struct; texts that are no object leave themselves in the corrupt column, blank ones are null."""
    return F.when(F.trim(c) != "", F.from_json(c, f"{schema}, {corrupt} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}))


def read_ndjson(spark: SparkSession, path: str, schema: str, corrupt: str = "_corrupt_record") -> DataFrame:
    """SRC4: one object a line; blank, malformed and other lines are skipped."""
    df = spark.read.text(path).select(_parsed(F.col("value"), schema, corrupt).alias("r"))
    return df.where(F.col("r").isNotNull() & F.col(f"r.{corrupt}").isNull()).select("r.*").drop(corrupt)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: (run, line_no, ts, level, message) of lines with a timestamp and a text; run is the file.  A message that
    is no JSON string doesn't count.  line_no follows the file, however it is split: the block's first byte, then the
    place within the task that read the block."""
    place = F.col("_metadata.file_block_start").cast("decimal(38,0)") * F.lit(2**33) + F.monotonically_increasing_id().bitwiseAND(2**33 - 1)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("run"), place.cast("decimal(38,0)").alias("line_no"), "value")
    message = F.try_variant_get(F.try_parse_json("value"), "$.message", "string")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json("value"), "$.message", "variant"))
    df = lines.select("run", "line_no", F.try_to_timestamp(F.get_json_object("value", "$.timestamp")).alias("ts"), F.coalesce(F.get_json_object("value", "$.level"), F.lit("")).alias("level"), F.when(kind == "STRING", message).alias("message"))
    return df.where("ts IS NOT NULL AND message IS NOT NULL")


def discover(spark: SparkSession, root: str, prefix: str) -> str:
    """SRC6: the glob of a family's snapshots, in candidates/ if there are any."""
    inner = f"{root}/candidates/{prefix}_*.json"
    return inner if _there(spark, inner) else f"{root}/{prefix}_*.json"


def landing(snapshots: DataFrame) -> DataFrame:
    """SRC7: snapshots as they are landed: every text of the payload repaired at any depth (TXT3, two rounds and both code
    pages), and the name they are kept under."""
    out = snapshots.withColumns({c: repair_payload(F.col(c), snapshots.schema[c].dataType) for c in snapshots.columns})
    named = [F.col(c) for c in ("document_type", "processo", "documento") if c in out.columns]
    return out.withColumn("name", safe_name(F.concat_ws("_", *named))) if named else out


def write_layer(df: DataFrame, path: str, run_id: str, by: list[str] = ()) -> None:
    """SRC7, SNK4: replaces only this run's partitions; older runs stay.  The latest run is a filter."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", *by).parquet(path)


def version_folder(root: str) -> tuple[str, str]:
    """A new folder under root for the tables of one attempt to publish a run, and its name."""
    version = uuid.uuid4().hex
    return f"{root}/versions/{version}", version


def commit_run(spark: SparkSession, root: str, run_id: str, version: str, names: list[str]) -> None:
    """SNK4: the manifest's entry of a run, one file written at once: from here on readers go to this version."""
    entry = spark.createDataFrame([(run_id, version, names)], "run_id string, version string, tables array<string>")
    entry.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/manifest")


def read_published(spark: SparkSession, root: str, name: str, run_id: str | None = None) -> DataFrame:
    """A table (`silver/act`, `gold/act`, `marts/overview`) of a published run: the given one, or the latest; of a run that was
    published again, the last version.  All tables of one run come from one version."""
    entries = spark.read.parquet(f"{root}/manifest")
    entries = entries if run_id is None else entries.where(F.col("run_id") == run_id)
    last = entries.agg(F.max(F.struct("run_id", "published_at", "version", "tables")).alias("e")).first()["e"]
    if last is None or name not in last["tables"]:
        raise ValueError(f"no published run {run_id or ''} with {name}")
    return spark.read.parquet(f"{root}/versions/{last['version']}/{name}")


def read_layer(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """One run of a layer: the given one, or the latest."""
    df = spark.read.parquet(path)
    return df.where(F.col("run_id") == run_id) if run_id else df.where(F.col("run_id") == df.agg(F.max("run_id")).first()[0])


def write_csv(df: DataFrame, path: str, columns: list[str], bom: bool = False) -> None:
    """SNK1: the columns in order, nulls empty, as one folder of CSV files; bom puts the byte-order mark of UTF-8 before
    the first column's name, which read_csv takes off."""
    names = ["\ufeff" + c if bom and i == 0 else c for i, c in enumerate(columns)]
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in zip(columns, names, strict=True)]).write.mode("overwrite").options(header=True, escape='"', emptyValue="").csv(path)


def append_raw_fields(df: DataFrame, path: str, run_id: str | None = None) -> None:
    """SNK2: raw fields behind those of earlier documents, with value_is_empty and value_has_date_like where the rows do
    not bring them, and the run if it is given."""
    from ..operators.extract import dated_value

    df = df if "value_is_empty" in df.columns else df.withColumn("value_is_empty", F.coalesce(F.trim("value"), F.lit("")) == "")
    df = df if "value_has_date_like" in df.columns else df.withColumn("value_has_date_like", F.coalesce(dated_value(fold(F.col("value"))), F.lit(False)))
    (df if run_id is None else df.withColumn("run_id", F.lit(run_id))).write.mode("append").parquet(path)


def write_previews(df: DataFrame, path: str, columns: list[str]) -> bool:
    """SNK3: cleaned cells; nothing is written for an empty table."""
    if df.isEmpty():
        return False
    write_csv(df.select(*[clean_spaces(F.col(c)).alias(c) for c in columns]), path, columns)
    return True


def write_spans(totals: DataFrame, path: str) -> None:
    """SNK5."""
    totals.write.mode("overwrite").json(path)


def canonical_aliases(gold: DataFrame) -> DataFrame:
    """SNK6: (processo, alias, source_path): names to publish winners under.  Overwriting the run's partition drops the
    alias of a case without a winner, so no file is copied."""
    return gold.select("processo", safe_name(F.concat_ws("_", "snapshot_prefix", "processo")).alias("alias"), F.col("json_path").alias("source_path"))


def publish_aliases(gold: DataFrame, path: str, run_id: str) -> DataFrame:
    """SNK6: writes the aliases of a run in place of those it had, so a case without a winner loses its alias, and
    returns what stands there."""
    write_layer(canonical_aliases(gold), path, run_id)
    return read_layer(gold.sparkSession, path, run_id)


def freshness(spark: SparkSession, path: str) -> DataFrame:
    """SRC9: (path, exists, mtime, size) of the files below a path; the signature that says whether to read again.  A path
    that isn't there is one row with exists = false."""
    if not _there(spark, path):
        return spark.createDataFrame([(path, False, None, None)], "path string, exists boolean, mtime timestamp, size long")
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.lit(True).alias("exists"), F.col("modificationTime").alias("mtime"), F.col("length").alias("size"))


def payload_value(payload: Column, *paths: str) -> Column:
    """The text at the first of the paths (`$.snapshot.title`, `$[0].objeto`) that a VARIANT payload has; objects and lists
    as JSON."""
    return F.coalesce(*[F.coalesce(F.try_variant_get(payload, p, "string"), F.to_json(F.try_variant_get(payload, p, "variant"))) for p in paths])


def payload_schema(df: DataFrame, payload: str = "payload") -> str:
    """The keys and types of all payloads of a table together, as one type text; empty for a table without any."""
    return df.agg(F.schema_of_variant_agg(payload).alias("s")).first()["s"] or ""


API_ITEM = "numero_processo string, numeroProcesso string, objeto string, valor_global string, valorGlobal string, situacao string, uf string, itens string"


def api_payload(df: DataFrame, body: str = "body") -> DataFrame:
    """SRC10: adds `payload`, the first item of a JSON list (or the object), under either spelling of its keys, and `item`,
    that item whole (VARIANT), for keys that the payload doesn't name."""
    parsed = F.try_parse_json(body)
    df = df.withColumn("item", F.coalesce(F.try_variant_get(parsed, "$[0]", "variant"), parsed))
    item = F.coalesce(F.get(F.from_json(body, f"array<struct<{API_ITEM.replace(' string', ':string')}>>"), F.lit(0)), F.from_json(body, API_ITEM))
    return df.withColumn("_i", item).withColumn("payload", F.struct(F.coalesce("_i.numero_processo", "_i.numeroProcesso").alias("numero_processo"), F.col("_i.objeto").alias("objeto"), F.coalesce("_i.valor_global", "_i.valorGlobal").alias("valor_global"), F.col("_i.situacao").alias("situacao"), F.col("_i.uf").alias("uf"), F.col("_i.itens").alias("itens"))).drop("_i")


def api_snapshot(payload: Column) -> Column:
    """SRC11: a snapshot of an API payload: a line for each value that is there."""
    line = lambda label, key: F.when(empty_to_null(payload[key]).isNotNull(), F.concat(F.lit(f"{label}: "), payload[key]))
    text = F.concat_ws("\n", F.lit("Termo de Execucao Descentralizada"), line("Processo", "numero_processo"), line("Objeto", "objeto"), line("Valor global", "valor_global"), line("Situacao", "situacao"), line("UF", "uf"))
    return F.struct(text.alias("text"), F.lit("api").alias("extraction_mode"))


#: Elements whose content is no text, and those that begin a line.
HIDDEN, LINES = ("script", "style"), ("p", "br", "div", "li", "tr", "h1", "h2", "h3")
#: An element's tag: quoted values may hold `>`.  Pieces of a page: comments and declarations, hidden elements whole, the title,
#: tags, and runs of text.
_TAG = r"""</?[A-Za-z](?:"[^"]*"|'[^']*'|[^>"']++)*+>"""
_EVENTS = rf"(?is)<!--.*?-->|<[!?][^>]*>|<({'|'.join(HIDDEN)})\b[^>]*>.*?(?:</\1\s*>|$)|<title\b[^>]*>.*?(?:</title\s*>|$)|{_TAG}|[^<]++|<"
_NAMED = ", ".join(f"'{name}', {code}" for name, code in sorted(name2codepoint.items()))


def unescaped(c: Column) -> Column:
    """Character references by name (HTML 4) and by number, as their characters; what is no reference stays."""
    def one(x: Column) -> Column:
        number = F.coalesce(F.conv(F.nullif(F.regexp_extract(x, r"^&#[xX]([0-9a-fA-F]{1,6});?$", 1), F.lit("")), 16, 10), F.nullif(F.regexp_extract(x, r"^&#([0-9]{1,7});?$", 1), F.lit(""))).cast("int")
        code = F.coalesce(number, F.try_element_at(F.expr(f"map({_NAMED})"), F.regexp_extract(x, "^&([A-Za-z0-9]+);?$", 1)))
        return F.coalesce(let(code, lambda n: F.when(n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))), x)

    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(F.regexp_extract_all(c, F.lit("&#?[A-Za-z0-9]+;?|[^&]++|&"), F.lit(0)), lambda x: F.when(F.startswith(x, F.lit("&")), one(x)).otherwise(x)), "")).otherwise(c)


def escapes_undone(c: Column) -> Column:
    """The three references that markup must escape as their characters, each in turn and the ampersand last; others stay."""
    return F.replace(F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))


def _event_text(x: Column) -> Column:
    """What an event adds to the visible text: itself, a line end, or nothing."""
    tag = F.lower(F.regexp_extract(x, "^<([A-Za-z][A-Za-z0-9]*)", 1))
    return F.when(~F.startswith(x, F.lit("<")) | (x == "<"), x).when(tag.isin(*LINES), "\n").otherwise("")


def _texts(events: Column) -> Column:
    return unescaped(F.array_join(F.transform(events, _event_text), ""))


def _tables(html: Column) -> Column:
    """Tables as their rows of cells: a table's region reaches to the next table's tag, a row's to the next row's; a cell counts
    when it is closed, with the text between its tags."""
    after = lambda x, tag: F.slice(F.split(x, rf"(?i)<{tag}(?=[\s>/])"), 2, 1_000_000)
    cell = lambda x: F.when(x.rlike("(?i)</t[dh]"), clean_spaces(_texts(F.regexp_extract_all(F.concat(F.lit("<i"), F.regexp_replace(x, r"(?is)</t[dh][\s>].*", "")), F.lit(_EVENTS), F.lit(0)))))
    row = lambda x: F.array_compact(F.transform(after(x, "t[dh]"), cell))
    return F.transform(after(html, "table"), lambda x: F.struct(F.transform(after(x, "tr"), row).alias("rows")))


def html_snapshots(df: DataFrame, html: str = "html", keep: list[str] = (), title_of: Callable[[Column], Column] = unescaped) -> DataFrame:
    """SRC12: title, text, tables and number of links of each page; null pages are empty.  title_of: how references in a
    title are read.

    A page is cut into events by one expression (tags, text, hidden elements, comments); the text is what they add in turn, in
    lines without blanks at their ends.  Built-in functions only; keep are columns that stay."""
    df = df.select(*keep, F.coalesce(html, F.lit("")).alias("_html"))
    df = df.withColumn("_events", F.regexp_extract_all("_html", F.lit(_EVENTS), F.lit(0)))
    title = F.get(F.filter("_events", lambda x: x.rlike(r"(?i)^<title\b")), F.lit(0))
    title = F.coalesce(clean_spaces(title_of(F.regexp_replace(F.regexp_replace(title, r"(?i)^<title[^>]*>", ""), r"(?i)</title\s*>$", ""))), F.lit(""))
    shown = F.filter("_events", lambda x: ~x.rlike(r"(?i)^<title\b"))
    lines = F.filter(F.transform(F.split(_texts(shown), "\n"), clean_spaces), lambda x: x != "")
    visible = F.regexp_replace("_html", rf"(?is)<!--.*?-->|<({'|'.join(HIDDEN)})\b[^>]*>.*?(?:</\1\s*>|$)", "")
    links = F.size(F.filter("_events", lambda x: x.rlike(r"(?i)^<a[\s>/]"))).cast("int")
    return df.select(*keep, title.alias("title"), F.array_join(lines, "\n").alias("text"), _tables(visible).alias("tables"), links.alias("links"))
