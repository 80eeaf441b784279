"""The operators' queries over the test tables, each next to its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.chat import format_chat, read_turns, unescape
from windrow.llm.exact import exact_dedup
from windrow.llm.language import identify
from windrow.llm.lines import line_dedup
from windrow.llm.manifest import merkle_manifest
from windrow.llm.middle import fill_in_middle
from windrow.llm.minhash import near_duplicates
from windrow.llm.mixing import mix
from windrow.llm.packing import pack
from windrow.llm.pieces import encode_documents
from windrow.llm.quality import classify
from windrow.llm.tokens import count_tokens
from windrow.llm.topk import top_k

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_minhash_near_dedup")
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op2_exact_top_k",
    """WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding,
    lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
)
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("before", F.col("text"))
    lines = lambda c: F.coalesce(F.size(F.split(c, "\n")), F.lit(0)).cast("long")
    return line_dedup(docs).select(
        "doc_id",
        lines("before").alias("n_lines"),
        (lines("before") - F.when(F.col("text") == "", 0).otherwise(lines("text"))).alias("n_dropped"),
        "text",
    )


@query(
    "op4_exact_dedup",
    r"""WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents
), g AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
    count(*) OVER (PARTITION BY t) AS group_size, sha256(t) AS text_sha256
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return count_tokens(table(spark, sf_dir, "documents"), path)


@query(
    "op6_mixing",
    r"""WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''),
    '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix') AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS n
  FROM d GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][(n - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM s
), r AS (
  SELECT *, 1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, n
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (ORDER BY cap / weight, n
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
    row_number() OVER (ORDER BY cap / weight, n) AS o
  FROM w
), l AS (
  SELECT CAST(rest AS DOUBLE) AS rest, CAST(open AS DOUBLE) AS open
  FROM r WHERE weight * CAST(rest AS DOUBLE) / open <= cap ORDER BY o LIMIT 1
), t AS (
  SELECT source, source_size, least(weight * (SELECT rest FROM l) / (SELECT open FROM l),
    CAST(cap AS DOUBLE)) AS target FROM w
), p AS (
  SELECT d.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
      ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, source,
  CAST(size * (budget // greatest(source_size, 1))
    + least(size, greatest(0, budget - budget // greatest(source_size, 1) * source_size - before))
    AS BIGINT) AS taken
FROM p""",
)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


# The conversation every run adds: texts that say what the template says.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def with_control(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    added = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    return conversations.select("conv_id", "turn", "role", "text").union(added)


@query(
    "op9_chat_formatting",
    r"""WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), s AS (
  SELECT *, CASE WHEN role IN ('system', 'user', 'assistant') THEN role ELSE 'other' END AS state FROM c
), o AS (
  SELECT *, coalesce(lag(state) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), 'start')
    || '>' || state IN ('start>system', 'start>user', 'system>user', 'user>assistant',
      'assistant>user', 'other>system', 'other>user') AS right_turn
  FROM s
)
SELECT conv_id, count(*) AS n_turns, count(*) FILTER (NOT right_turn) AS n_wrong,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### : </turn>') + 1
    + CASE WHEN role IN ('System', 'User', 'Assistant') THEN 2 ELSE 0 END
    + length(regexp_replace(role, '([\\#:<])', '\\\1', 'g'))
    + length(regexp_replace(text, '([\\#:<])', '\\\1', 'g'))) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id""",
)
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = format_chat(with_control(spark, table(spark, sf_dir, "conversations")))
    turns = read_turns(F.col("formatted"))
    read = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    under_loss = F.filter("segments", lambda s: s["loss"])
    loss = F.array_join(F.transform(under_loss, lambda s: unescape(s["text"])), "")
    digest = blocks.select(
        "conv_id",
        F.size(turns).cast("long").alias("n"),
        "n_wrong",
        F.char_length("formatted").cast("long").alias("chars"),
        F.struct("block", F.array_join(read, "").alias("read"), loss.alias("loss")).alias("b"),
    )
    # A digest is of one text: what a conversation says comes together here and only here.
    whole = digest.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum("n_wrong").alias("n_wrong"),
        F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list("b")).alias("b"),
    )
    said, lost = F.array_join("b.read", ""), F.array_join("b.loss", "")
    return whole.select(
        "conv_id",
        "n_turns",
        "n_wrong",
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_documents(table(spark, sf_dir, "documents"), path)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op11_merkle_manifest",
    r"""WITH RECURSIVE f AS (
  SELECT doc_id, source, text, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)] AS told,
    -- crc32 of the id's digits, a byte and then eight shifts at a time
    xor(list_reduce(list_prepend(4294967295, list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc
  FROM documents
), g AS (
  SELECT doc_id, source, array_to_string(list_transform(told,
      lambda v: coalesce(strlen(v) || ':' || v, '-')), '') AS head, text,
    CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      ELSE text END AS changed
  FROM f
), d AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS tampered
  FROM g
), p AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY source) AS size
  FROM d
), tree AS (
  SELECT 0 AS level, source, place, leaf AS digest, size FROM p
  UNION ALL
  SELECT level + 1, source, place // 16, sha256(string_agg(digest, '' ORDER BY place)),
    (size + 15) // 16
  FROM tree WHERE size > 1 GROUP BY level, source, place // 16, size
), s AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
    count(*) OVER () AS size
  FROM tree WHERE size = 1
), top AS (
  SELECT 0 AS level, place, subroot AS digest, size FROM s
  UNION ALL
  SELECT level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (size + 15) // 16
  FROM top WHERE size > 1 GROUP BY level, place // 16, size
), runs AS (
  SELECT level, source, place // 16 AS run, list(digest ORDER BY place) AS digests
  FROM tree WHERE size > 1 GROUP BY level, source, place // 16
), top_runs AS (
  SELECT level, place // 16 AS run, list(digest ORDER BY place) AS digests
  FROM top WHERE size > 1 GROUP BY level, place // 16
), fold AS (
  SELECT doc_id, leaf, source, 0 AS level, place, tampered AS digest, '' AS proof FROM p
  UNION ALL
  SELECT f.doc_id, f.leaf, f.source, f.level + 1, f.place // 16,
    sha256(array_to_string(r.digests[1:f.place % 16], '') || f.digest
      || array_to_string(r.digests[f.place % 16 + 2:], '')),
    f.proof || array_to_string(r.digests[1:f.place % 16], '')
      || array_to_string(r.digests[f.place % 16 + 2:], '')
  FROM fold f JOIN runs r ON r.level = f.level AND r.run = f.place // 16
    AND r.source IS NOT DISTINCT FROM f.source
), folded AS (
  SELECT f.*, s.place AS top_place, s.subroot, (SELECT digest FROM top WHERE size = 1) AS root
  FROM fold f JOIN s ON s.source IS NOT DISTINCT FROM f.source
  QUALIFY f.level = max(f.level) OVER (PARTITION BY f.source)
), up AS (
  SELECT doc_id, leaf, subroot, root, 0 AS level, top_place AS place, digest, proof FROM folded
  UNION ALL
  SELECT f.doc_id, f.leaf, f.subroot, f.root, f.level + 1, f.place // 16,
    sha256(array_to_string(r.digests[1:f.place % 16], '') || f.digest
      || array_to_string(r.digests[f.place % 16 + 2:], '')),
    f.proof || array_to_string(r.digests[1:f.place % 16], '')
      || array_to_string(r.digests[f.place % 16 + 2:], '')
  FROM up f JOIN top_runs r ON r.level = f.level AND r.run = f.place // 16
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, digest AS folded_root,
  digest = root AS verified
FROM up WHERE level = (SELECT max(level) FROM top)""",
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"))


@query("op12_packing")
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(table(spark, sf_dir, "documents"), path).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query(
    "op13_fill_in_middle",
    r"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS parts,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), n AS (
  SELECT *, len(parts) - CASE WHEN parts[-1] = '' THEN 1 ELSE 0 END AS n,
    list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS hs
  FROM d
), f AS (
  SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR hs[3] % 100 >= 100 THEN 'plain'
    WHEN hs[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM n
), c AS (
  SELECT *, CASE WHEN a = 0 THEN 0 WHEN a = n THEN length(t)
      ELSE length(array_to_string(parts[1:a], chr(10))) + 1 END AS x,
    CASE WHEN b = 0 THEN 0 WHEN b = n THEN length(t)
      ELSE length(array_to_string(parts[1:b], chr(10))) + 1 END AS y
  FROM f
), o AS (
  SELECT *, t[:x] AS p, t[x + 1:y] AS m, t[y + 1:] AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM o""",
)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents")).drop("output")
