"""The operators as named queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import attribution, bpe, chat, collocations, edit_embedding, exact_dedup, kneser_ney, langid, mixing, ngram_join, shard_tree, spelling, token_files
from orderloom.llm.scratch import settle, stored
from orderloom.llm.text import id_crc
from orderloom.session import fresh_path, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(settle(tune(spark)), sf_dir)
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_edit_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.fingerprint_edits(documents(spark, sf_dir))


@query("op2_chunked_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), tokenizer())


@query("op3_rans_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write(documents(spark, sf_dir), fresh_path(spark, "token-files"), tokenizer(), END_ID)
    return token_files.read_digests(spark, folder)


@query("op8_line_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.section_tokens(documents(spark, sf_dir), tokenizer())


#: The id that ends every document in token files.
END_ID = 2
#: 2 regions of 3 racks of 4 shards.
TREE = shard_tree.even_tree(2, 3, 4)


def _shards_sql(tree: list[shard_tree.Shard], more: list[shard_tree.Shard]) -> str:
    """The same descent with the trees' nodes as a table; crc32 bit by bit from its polynomial."""
    nodes = ", ".join(
        f"('{name}', {parent}, '{path}', {weight!r}e0, {node}, {place})"
        for name, shards in (("now", tree), ("grown", more))
        for parent, children in enumerate(shard_tree._children(shards))
        for place, (path, weight, node) in enumerate(children)
    )
    bits = f"CAST('0x' || substr(md5('{shard_tree.SEED}' || path || '/' || key), 1, 13) AS BIGINT)"
    steps = "".join(
        f"""s{i} AS (
  SELECT rn, key, tree, first(nodes.node ORDER BY -ln(({bits} + 1) / 4503599627370496e0) / weight, place) AS node
  FROM {"(SELECT rn, key, t.tree, 0 AS node FROM d, (VALUES ('now'), ('grown')) t(tree))" if i == 1 else f"s{i - 1}"} x
  JOIN nodes ON nodes.tree = x.tree AND nodes.parent = x.node
  GROUP BY rn, key, x.tree, tree),
""".replace("SELECT rn, key, tree,", "SELECT rn, key, x.tree,").replace("GROUP BY rn, key, x.tree, tree", "GROUP BY rn, key, x.tree")
        for i in (1, 2, 3)
    )
    return f"""
WITH crcs AS (
  SELECT list(v ORDER BY i) AS crc
  FROM (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
                              lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
        FROM range(256) r(i))),
d AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key, coalesce(text, '') AS text
  FROM documents),
h AS (
  SELECT rn, doc_id, key, CAST(strlen(text) + 8 AS BIGINT) AS size,
         list_transform(regexp_extract_all(hex(text), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes
  FROM d),
c AS (
  SELECT rn, doc_id, key, size, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
                                    lambda c, b: xor(c // 256, crc[xor(c % 256, b) + 1]))) AS text_crc32
  FROM h, crcs),
nodes(tree, parent, path, weight, node, place) AS (VALUES {nodes}),
{steps}r AS (
  SELECT c.*, a.node AS shard, b.node AS grown_shard,
         CAST('0x' || substr(md5('{shard_tree.SEED}/slot/' || c.key), 1, 8) AS BIGINT)
           % greatest(1, (SELECT CAST(ceil(count(*) / {len(tree) * shard_tree.ROWS_PER_RUN}e0) AS BIGINT) FROM d)) AS run
  FROM c JOIN s3 a ON a.rn = c.rn AND a.tree = 'now' JOIN s3 b ON b.rn = c.rn AND b.tree = 'grown')
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY run, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot
FROM r
"""


@query("op4_hash_tree_shards", _shards_sql(TREE, shard_tree.grown(TREE)))
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_tree.assign(documents(spark, sf_dir), TREE, shard_tree.grown(TREE))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k
  FROM documents),
s AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY k),
w AS (SELECT *, (row_number() OVER (ORDER BY k) - 1) % 3 + 1 AS weight FROM s),
l AS (
  SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0) AS DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY source_size / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT level FROM l WHERE level * weight <= CAST(3 * source_size AS DOUBLE) ORDER BY source_size / weight, k LIMIT 1),
t AS (
  SELECT k, source_size, least((SELECT level FROM v) * weight, CAST(3 * source_size AS DOUBLE)) AS target,
         CAST(('0x' || substr(md5('mix/offset/' || k), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
  FROM l),
r AS (
  SELECT d.*, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS f,
         row_number() OVER (PARTITION BY k ORDER BY size, md5('mix/row/' || coalesce(CAST(doc_id AS VARCHAR), 'null'))) - 1 AS pos
  FROM d JOIN t USING (k))
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       size * CAST(CASE WHEN f >= 3 THEN 3 ELSE floor((pos + 1) * f + u) - floor(pos * f + u) END AS BIGINT) AS taken
FROM r
"""


@query("op5_systematic_mix", MIX_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("copies")


COPIES_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT doc_id, text, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM g
"""


@query("op6_grace_dedup", COPIES_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.text_classes(documents(spark, sf_dir))


@query("op9_hyperdimensional_language")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fold = id_crc("doc_id") % 4
    keep = (F.col("doc_id"), (fold == 2).alias("held_out"))
    return langid.identify(docs, fold != 2, keep=keep)


@query("op10_kneser_ney_scores")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = id_crc("doc_id") % 10 == 0
    model = kneser_ney.train(docs.where(~held_out))
    return kneser_ney.score(docs, model, keep=(held_out.alias("held_out"),))


JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rn, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS MATERIALIZED (
  SELECT rn, doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [ws]
                                   ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i : i + 3]) END) AS sh
  FROM w),
e AS MATERIALIZED (SELECT rn, len(sh) AS n, unnest(sh) AS x FROM s),
o AS (
  SELECT a.rn AS a, b.rn AS b, a.n AS na, b.n AS nb, count(*) AS m
  FROM e a JOIN e b ON a.x = b.x AND a.rn < b.rn GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM o WHERE 100 * m >= 85 * (na + nb - m)),
t AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM t UNION SELECT r.a, t.b FROM r JOIN t ON r.b = t.a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles,
       least(s.doc_id, (SELECT min(z.doc_id) FROM r JOIN s z ON z.rn = r.b WHERE r.a = s.rn)) AS component_id
FROM s
"""


@query("op7_sparse_jaccard_join", JACCARD_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(documents(spark, sf_dir), width=4, percent=85)


#: A word of a document loses a letter where the crc32 of id and word is divisible by this.
TYPOS = 97

SPELLING_SQL = r"""
WITH RECURSIVE crcs AS (
  SELECT list(v ORDER BY i) AS crc
  FROM (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
                              lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
        FROM range(256) r(i))),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
d AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
h AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
           regexp_extract_all(hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run), '..'), lambda x: CAST('0x' || x AS BIGINT))),
           lambda c, b: xor(c // 256, crc[xor(c % 256, b) + 1]))) AS h
  FROM d, crcs),
o AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM o WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
k AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) AS head, substr(word, i + 2) AS tail
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
near AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b, b.n FROM k a JOIN k b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT k.word, v.word, v.n FROM k JOIN v ON v.word = k.head || k.tail
  UNION SELECT v.word, k.word, k.n FROM k JOIN v ON v.word = k.head || k.tail),
best AS (SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, b) AS b, max(n) AS n FROM near GROUP BY a),
f AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 2 * v.n THEN b END AS form,
         CASE WHEN best.n >= 2 * v.n THEN best.n END AS form_n
  FROM v LEFT JOIN best ON best.a = v.word),
chain(word, root, steps) AS (
  SELECT word, word, 0 FROM f
  UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN ends ON ends.word = f.word
"""


@query("op11_trie_spelling_variants", SPELLING_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir), shortest=5, least=3, typos=TYPOS)


#: A conversation that says what the template itself is made of.
ODD_CHAT = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def _chat_sql() -> str:
    escaped = "replace(text, chr(92), chr(92) || chr(92))"
    for control in chat.CONTROLS:
        c = control.decode()
        escaped = f"replace({escaped}, '{c}', '{c[0]}' || chr(92) || '{c[1:]}')"
    around = " ".join(f"WHEN '{r}' THEN {len(chat.CONTROLS[o]) + len(chat.CONTROLS[chat.CLOSES[o]]) + 2}" for r, o in chat.OPENS.items())
    role = escaped.replace("replace(text,", "replace(role,")
    other = 4 + sum(len(chat.CONTROLS[k]) for k in (chat.ROLE, chat.ROLE_END, chat.CLOSES[chat.ROLE_END]))
    odd = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in ODD_CHAT)
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {odd}) v),
t AS (SELECT *, length({escaped}) + CASE role {around} ELSE {other} + length({role}) END AS formatted FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


@query("op12_columnar_chat_format", _chat_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    chats = given.unionByName(spark.createDataFrame(ODD_CHAT, "conv_id long, turn long, role string, text string"))
    return chat.digests(stored(chat.format_chats(chats), "chats"))


COLLOCATION_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?
-]')) AS piece
  FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS ws FROM p),
g AS (
  SELECT lang, 1 AS size, unnest(ws) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: array_to_string(ws[i : i + 1], ' '))) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i : i + 2], ' '))) FROM w),
c AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS n FROM g GROUP BY ALL),
s AS MATERIALIZED (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS ws FROM c WHERE size > 1 AND n >= 10),
k AS (SELECT *, unnest(range(1, size)) AS k FROM s),
x AS (
  SELECT k.lang, k.phrase, k.a, k, l.n AS l, r.n AS r,
         (CAST(1000000 AS HUGEINT) * a * a) // (CAST(l.n AS HUGEINT) * r.n) AS score
  FROM k JOIN c l ON l.lang = k.lang AND l.phrase = array_to_string(ws[1:k], ' ')
         JOIN c r ON r.lang = k.lang AND r.phrase = array_to_string(ws[k + 1:k.size], ' ')),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (
  SELECT lang, phrase, max(a) AS a
  FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM s WHERE size = 3)
  GROUP BY ALL),
t AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM c WHERE size = 1 GROUP BY lang),
z AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, l, r,
         CAST(score AS BIGINT) AS score
  FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.a IS NULL OR 100 * i.a < 50 * b.a)
SELECT z.lang, rank, phrase, a, l, r, t.n, score FROM z JOIN t ON t.lang = z.lang WHERE rank <= 2000
"""


@query("op13_toivonen_collocations", COLLOCATION_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir), longest=3, least=10, share=50, top=2000)
