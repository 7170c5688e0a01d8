"""The registered queries of this package and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from rivulet.llm.bpe import decode_ids, encode_texts
from rivulet.llm.common import documents
from rivulet.llm.decontaminate import find_items
from rivulet.llm.language_id import identify
from rivulet.llm.licenses import scan_licenses
from rivulet.llm.line_dedup import drop_shared_lines
from rivulet.llm.manifest import manifest
from rivulet.llm.mixing import mix_sizes
from rivulet.llm.near_dedup import near_duplicates
from rivulet.llm.oracles import MANIFEST, REPAIR
from rivulet.llm.quality import score_documents
from rivulet.llm.repair import damaged, repair_all
from rivulet.llm.substring_dedup import remove_repeated
from rivulet.llm.token_counts import count_tokens
from rivulet.llm.tool_calls import link_tool_calls
from rivulet.util import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


@query(
    """with lines as (
  select doc_id, text, source, unnest(string_split(text, chr(10))) as line,
    unnest(range(len(string_split(text, chr(10))))) as pos
  from documents where text is not null
), bare as (
  select *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as key from lines
), shared as (
  select key from bare where key <> '' group by key
  having count(distinct coalesce('s' || source, 'n')) >= 10
), kept as (
  select doc_id, count(*) as n_lines, count(*) filter (s.key is not null) as n_removed,
    string_agg(line, chr(10) order by pos) filter (s.key is null) as kept
  from bare b left join shared s on b.key = s.key group by doc_id
)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed,
  case when text is not null then coalesce(kept, '') end as text
from documents d left join kept k on d.doc_id = k.doc_id"""
)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten sources or more share."""
    found = drop_shared_lines(documents(spark, sf_dir), "source", 10)
    return found.select(
        "doc_id", "n_lines", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), "text"
    )


TOOLS = [
    ("search", "query", "string", True),
    ("search", "limit", "integer", False),
    ("lookup", "id", "integer", True),
    ("lookup", "field", "string", True),
    ("translate", "text", "string", True),
    ("translate", "target", "string", False),
]


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tool calls and results derived from turns.

    An assistant's turn is a call; its tool, arguments and mistakes follow from the length
    of its text, and it depends on the calls two and four turns before. A user's turn is
    the result of the call of the turn before.
    """
    n = F.length("text")
    fields = {"ignoreNullFields": "true"}
    search = F.to_json(
        F.struct(
            F.col("text").alias("query"), (n % 50).alias("limit"),
            F.when(n % 7 == 0, "xx").alias("lang"),
        ), fields,
    )
    number = F.to_json(F.struct(F.col("conv_id").alias("id"), F.col("role").alias("field")))
    string = F.to_json(
        F.struct(F.col("conv_id").cast("string").alias("id"), F.col("role").alias("field"))
    )
    translate = F.to_json(
        F.struct(F.lit("en").alias("target"), F.when(n % 5 != 0, F.col("text")).alias("text")),
        fields,
    )

    def call(back: int) -> Column:
        return F.concat(F.lit("call_"), F.col("turn") - back)

    after = F.filter(
        F.array(
            F.when((F.col("turn") >= 2) & (n % 5 != 0), call(2)),
            F.when((F.col("turn") >= 4) & (n % 3 == 0), call(4)),
        ),
        lambda x: x.isNotNull(),
    )
    calls = conversations.where("role = 'assistant'").select(
        "conv_id", F.col("turn").alias("seq"), call(0).alias("call_id"),
        F.when(n % 4 == 0, "search").when(n % 4 == 1, "lookup").when(n % 4 == 2, "translate")
        .otherwise("other").alias("name"),
        F.when(n % 4 == 0, search).when((n % 4 == 1) & (n % 3 == 0), string)
        .when(n % 4 == 1, number).when(n % 4 == 2, translate).when(n % 8 == 3, "{}")
        .otherwise(F.col("text")).alias("arguments"),
        after.alias("after"),
    )
    results = conversations.where("role = 'user' and turn >= 1").select(
        "conv_id", F.col("turn").alias("seq"), call(1).alias("call_id"),
        F.col("text").alias("content"),
    )
    return calls, results


@query(
    """with recursive c as (
  select conv_id, turn, text, role, length(text) as n from conversations
), calls as (
  select conv_id, turn, 'call_' || turn as call_id, text, role, n,
    case n % 4 when 0 then 'search' when 1 then 'lookup' when 2 then 'translate' else 'other' end as name
  from c where role = 'assistant'
), wished as (
  select conv_id, turn, turn - 2 as dep from calls where turn >= 2 and n % 5 <> 0
  union all select conv_id, turn, turn - 4 from calls where turn >= 4 and n % 3 = 0
), edges as (
  select w.* from wished w join calls p on p.conv_id = w.conv_id and p.turn = w.dep
), depth as (
  select conv_id, turn, 0 as d from calls
  union select e.conv_id, e.turn, depth.d + 1 from edges e
  join depth on depth.conv_id = e.conv_id and depth.turn = e.dep
), levels as (select conv_id, turn, max(d) as level from depth group by all
), absent as (
  select w.conv_id, w.turn, list(distinct 'dependency:call_' || w.dep) as missing
  from wished w left join calls p on p.conv_id = w.conv_id and p.turn = w.dep
  where p.turn is null group by all
), judged as (
  select c.*, level, coalesce(missing, []) as missing, r.text as result,
    case name
      when 'search' then '{' || case when c.n % 7 = 0 then '"lang":"xx",' else '' end
        || '"limit":' || (c.n % 50) || ',"query":' || to_json(c.text) || '}'
      when 'lookup' then '{"field":' || to_json(c.role) || ',"id":'
        || case when c.n % 3 = 0 then '"' || c.conv_id || '"' else '' || c.conv_id end || '}'
      when 'translate' then '{"target":"en"'
        || case when c.n % 5 <> 0 then ',"text":' || to_json(c.text) else '' end || '}'
      else case when c.n % 8 = 3 then '{}' else to_json(c.text) end end as arguments,
    case name
      when 'search' then case when c.n % 7 = 0 then ['unknown:lang'] else [] end
      when 'lookup' then case when c.n % 3 = 0 then ['type:id'] else [] end
      when 'translate' then case when c.n % 5 = 0 then ['missing:text'] else [] end
      else case when c.n % 8 = 3 then ['unknown_tool'] else ['no_object'] end end as wrong
  from calls c join levels using (conv_id, turn) left join absent using (conv_id, turn)
  left join c r on r.conv_id = c.conv_id and r.turn = c.turn + 1 and r.role = 'user'
)
select conv_id, call_id, turn as seq, level,
  case when len(wrong) + len(missing) > 0 then 'invalid' when result is null then 'unanswered'
    else 'ok' end as status,
  array_to_string(list_sort(list_concat(wrong, missing)), ',') as errors,
  '{"arguments":' || arguments || ',"id":"' || call_id || '","name":"' || name || '","result":'
    || coalesce(to_json(result), 'null') || '}' as message
from judged
union all
select r.conv_id, 'call_' || (r.turn - 1), r.turn, null, 'orphan_result', '', null
from c r left join calls on calls.conv_id = r.conv_id and calls.turn = r.turn - 1
where r.role = 'user' and r.turn >= 1 and calls.turn is null"""
)
def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and results of all conversations, linked, ordered, validated, serialised."""
    calls, results = calls_of(documents(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame(TOOLS, "name string, param string, type string, required boolean")
    linked = link_tool_calls(calls, results, schemas)
    return linked.withColumn("errors", F.array_join("errors", ","))


@query()
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document, as a file of its source's tree.

    Every eighth document is a license file of its directory, some of them further up.
    """
    a, b = F.floor(F.col("doc_id") / 64) % 16, F.floor(F.col("doc_id") / 8) % 8
    name = F.concat(F.lit("LICENSE-"), "doc_id")
    path = (
        F.when(F.col("doc_id") % 512 == 0, F.concat_ws("/", "lang", name))
        .when(F.col("doc_id") % 64 == 0, F.concat_ws("/", "lang", a, name))
        .when(F.col("doc_id") % 8 == 0, F.concat_ws("/", "lang", a, b, name))
        .otherwise(F.concat_ws("/", "lang", a, b, F.concat("doc_id", F.lit(".txt"))))
    )
    files = documents(spark, sf_dir).select(
        F.col("doc_id").alias("file_id"), F.col("source").alias("repo"), path.alias("path"), "text"
    )
    return scan_licenses(files).select(
        F.col("file_id").alias("doc_id"), "path", "own", F.round("score", 6).alias("score"),
        "license", "origin",
    )


@query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, score and verdict of every document."""
    scored = score_documents(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the labelled ones that are not held out."""
    return identify(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents without passages of 35 words that occur elsewhere too."""
    return remove_repeated(documents(spark, sf_dir), size=35).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


@query()
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in all documents."""
    found = find_items(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "start", "n_words"
    )


@query()
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes of each, by source weights 5, 2, 1."""
    return mix_sizes(documents(spark, sf_dir))


@query()
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on four-word shingles."""
    found = near_duplicates(documents(spark, sf_dir), shingle=4, percent=80)
    return found.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, through a cache of its own for this run."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    return count_tokens(documents(spark, sf_dir), scratch_dir(spark, "token-cache"), definition)


@query(REPAIR)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cost, audit and repaired digest of all conversations, once damaged."""
    conversations = documents(spark, sf_dir, "conversations")
    return repair_all(conversations, damaged(conversations))


@query()
def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to, as digests."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    decoded = decode_ids(encode_texts(documents(spark, sf_dir), definition), definition)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


@query(MANIFEST)
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaf, proof and verification of every document; a fifth arrives altered."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return manifest(documents(spark, sf_dir), tampered=crc % 5 == 0)
