"""The queries opN_<name> over the given tables and, where SQL can express them, the SQL with the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.llm.alignment import align_tokenizers
from churnspark.llm.chat import CONTROLS, END, START, read_conversations, render_conversations
from churnspark.llm.decontaminate import decontaminate
from churnspark.llm.embedding_links import embedding_links
from churnspark.llm.language import fit_language_model, predict_language
from churnspark.llm.mixing import mix_sources
from churnspark.llm.ngram_join import ngram_join
from churnspark.llm.packing import pack_documents
from churnspark.llm.periodic_runs import periodic_runs
from churnspark.llm.quality import fit_quality_model, score_quality
from churnspark.llm.sharding import shard_documents
from churnspark.llm.substring_dedup import substring_dedup
from churnspark.llm.token_files import read_token_frames, write_token_frames
from churnspark.session import staged

LLM_QUERIES: dict = {}
LLM_ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(fn):
        LLM_QUERIES[fn.__name__] = fn
        if sql:
            LLM_ORACLE[fn.__name__] = sql
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SPACED = r"'[^\x20\x09-\x0D]+'"


@_query(
    rf"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS ws FROM documents),
    win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS h
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
    later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
    word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
    kept AS (SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.i) FILTER (WHERE gone.i IS NULL) AS t, count(gone.i) AS n_removed
             FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY word.doc_id)
    SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""
)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@_query(
    rf"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_SPACED}))::BIGINT AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
    l AS (SELECT source, source_size, weight, 3 * source_size AS most, 3 * source_size / weight AS level FROM s),
    k AS (SELECT a.level, (SELECT sum(source_size) FROM l) - coalesce(sum(b.most) FILTER (WHERE b.level < a.level), 0) AS rest,
                 sum(b.weight) FILTER (WHERE b.level >= a.level) AS weights
          FROM (SELECT DISTINCT level FROM l) a, l b GROUP BY a.level),
    c AS (SELECT rest::BIGINT AS rest, weights::BIGINT AS weights FROM k WHERE rest <= level * weights ORDER BY level LIMIT 1),
    t AS (SELECT source, source_size, least(most::DOUBLE, weight * rest / weights) AS target FROM l, c),
    r AS (SELECT doc_id, d.source, size, source_size, target, floor(target / source_size) AS rounds,
                 sum(size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || doc_id) ROWS UNBOUNDED PRECEDING) AS upto
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           (CASE WHEN size = 0 THEN 0
                 ELSE size * (rounds + CASE WHEN 2 * upto - size <= 2 * (target - rounds * source_size) THEN 1 ELSE 0 END) END)::BIGINT AS taken
    FROM r"""
)
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query(
    rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, {_PLAIN}) AS ws FROM documents),
    b AS (SELECT item_id, regexp_extract_all({_LOWERED}, {_PLAIN}) AS ws FROM benchmark),
    win AS (SELECT DISTINCT item_id, ws[i:i + 9] AS w
            FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
    lens AS (SELECT DISTINCT len(w) AS n FROM win),
    dw AS (SELECT doc_id, i, n, ws[i:i + n - 1] AS w
           FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d JOIN lens ON len(ws) >= n)),
    f AS (SELECT doc_id, i, n, item_id FROM dw JOIN win ON dw.w = win.w),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM f) GROUP BY doc_id),
    it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM f) GROUP BY doc_id)
    SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN it ON d.doc_id = it.doc_id"""
)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated")


def _held_out(parts: int, part: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts)) == part


@_query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_language_model(docs.where(~_held_out(4, 2)))
    found = predict_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")


@_query()
def op9_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"))


@_query()
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality").where(~_held_out(3, 1)).dropna()
    model = fit_quality_model(docs, labels=labels)
    found = score_quality(docs, model)
    return found.select("doc_id", _held_out(3, 1).alias("held_out"), "score", "predicted")


_CONTROL_TURN = "</s>[INST] ok [/INST]"
_ESCAPED_CHARS = "len(text) + (len(text) - len(replace(text, '\\', '')))" + "".join(
    f" + (len(text) - len(replace(text, '{c}', ''))) // {len(c)}" for c in CONTROLS
)


@_query(
    f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -1, 0, 'user', '{_CONTROL_TURN}' UNION ALL SELECT -1, 1, 'assistant', '{_CONTROL_TURN}')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum({len(START)} + len(role) + 1 + {_ESCAPED_CHARS} + {len(END)})::BIGINT AS formatted_chars
    FROM c GROUP BY conv_id"""
)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = [(-1, 0, "user", _CONTROL_TURN), (-1, 1, "assistant", _CONTROL_TURN)]
    turns = turns.unionByName(spark.createDataFrame(fixed, turns.schema))
    events = turns.select("conv_id", "turn", F.lit(0).alias("seq"), F.lit("message").alias("kind"), "role", "text")
    return read_conversations(staged(render_conversations(events), "chat"))


@_query(
    rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, {_SPACED}) AS ws FROM documents),
    sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [md5(array_to_string(ws, ' '))]
                  ELSE list_transform(range(1, len(ws) - 2), lambda i: md5(array_to_string(ws[i:i + 3], ' '))) END) AS s FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
    r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
    k AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
    SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id FROM w JOIN k ON k.x = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id"""
)
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_table(spark, sf_dir, "documents"))


@_query()
def op8_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(_table(spark, sf_dir, "embeddings"))


@_query()
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    frames = write_token_frames(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_frames(frames)


def _planted(text):
    """The text with a period planted by the rule of the query: from word a on, words repeat after p of them."""
    check = F.crc32(F.col("doc_id").cast("string"))
    draw = F.floor(check / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size(words)
    a = F.pmod(draw, n).cast("int")
    p = (F.floor((n - a) / (3 + F.pmod(draw, F.lit(8)))) + 1).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a))
    some = (F.pmod(check, F.lit(10)) == 0) & F.coalesce(F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    return F.when(some, F.array_join(planted, " ")).otherwise(text)


_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda s, v: CASE WHEN v >= 0 THEN xor(s, v) ELSE xor(s >> 1, 3988292384 * (s & 1)) END), 4294967295)"""


@_query(
    rf"""
    WITH o AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS ws, {_CRC32} AS h FROM documents),
    g AS (SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) ELSE len(ws) END AS a FROM o),
    p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM g),
    w AS (SELECT doc_id, n, list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) AS ws FROM p),
    six AS (SELECT doc_id, i, ws[i + 1:i + 6] AS s FROM (SELECT doc_id, ws, unnest(range(n - 5)) AS i FROM w WHERE n >= 6)),
    met AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM six x JOIN six y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
    isle AS (SELECT doc_id, q, min(i) AS a, max(i) + 6 + q AS b
             FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM met) GROUP BY doc_id, q, k),
    run AS (SELECT doc_id, a, b - a AS l, min(q) AS q FROM isle WHERE b - a >= greatest(12, 2 * q) GROUP BY doc_id, a, b),
    listed AS (SELECT doc_id, count(*) AS n_runs, arg_max({{'a': a, 'l': l, 'q': q}}, [l, -a, -q]) AS best,
                      string_agg(a || ',' || l || ',' || q || chr(10), '' ORDER BY a, q) AS runs FROM run GROUP BY doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(a + q, a + l)) AS i FROM run),
    word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(n)) AS i FROM w),
    kept AS (SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.i) FILTER (WHERE gone.i IS NULL) AS t
             FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY word.doc_id)
    SELECT w.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.a::BIGINT AS start, best.l::BIGINT AS length, best.q::BIGINT AS period,
           (1000 * best.l // best.q)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
    FROM w LEFT JOIN listed ON w.doc_id = listed.doc_id LEFT JOIN kept ON w.doc_id = kept.doc_id"""
)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", _planted(F.col("text")).alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    start, length, period = -longest["col2"], longest["length"], -longest["col3"]
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_query()
def op12_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query()
def op11_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocabulary

    docs = _table(spark, sf_dir, "documents")
    found = align_tokenizers(docs, vocabulary.path("byte_bpe_50k.json"), vocabulary.path("piece_bpe_32k.model"))
    return found.withColumnRenamed("groups", "groups_sha256")
