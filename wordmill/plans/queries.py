"""Registry of named queries: each takes (spark, sf_dir) and returns a
DataFrame over the supplied tables; ORACLES holds the DuckDB SQL of those
that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tokens as tk
from ..operators import vocab as vc
from ..session import read_table
from . import oracle as O

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- shared inputs
def documents(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def doc_vocab(spark, sf_dir):
    return vc.build_vocab(tk.count_tokens(documents(spark, sf_dir)))


def benchmark(spark, sf_dir):
    return read_table(spark, sf_dir, "benchmark").select("item_id", "text")


# ---------------------------------------------------------------- 2.1 corpus
@register("read_corpus", "SELECT doc_id, text FROM documents")
def q_read_corpus(spark, sf_dir):
    from ..sources.corpus import read_corpus

    return read_corpus(spark, f"{sf_dir}/documents.parquet").select("doc_id", "text")


_TRIM = "[\\t\\n\\x0B\\f\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"


@register(
    "normalize_text",
    f"""SELECT doc_id, regexp_replace(replace(replace(text, chr(10) || chr(10), ' '), chr(10), ' '),
        '^{_TRIM}+|{_TRIM}+$', '', 'g') AS text FROM documents""",
)
def q_normalize_text(spark, sf_dir):
    return tk.normalize_text(documents(spark, sf_dir))


# ---------------------------------------------------------------- 2.2 tokens
@register("split_words", f"SELECT doc_id, w AS words FROM ({O.words_cte()})")
def q_split_words(spark, sf_dir):
    return tk.split_words(documents(spark, sf_dir)).select("doc_id", "words")


@register("explode_tokens", O.tokens_cte())
def q_explode_tokens(spark, sf_dir):
    return tk.explode_tokens(documents(spark, sf_dir))


@register(
    "special_tokens",
    O.doc_vocab_with(
        f""", enc AS ({O.encode_cte('documents', 'doc_id', 'text')})
        SELECT v.token, v.id, count(e.token_id) AS occurrences, count(DISTINCT e.doc_id) AS sequences
        FROM vocab v LEFT JOIN (SELECT doc_id, unnest(ids) AS token_id FROM enc) e ON e.token_id = v.id
        WHERE v.id < 4 GROUP BY ALL"""
    ),
)
def q_special_tokens(spark, sf_dir):
    return vc.special_token_usage(tk.encode(documents(spark, sf_dir), doc_vocab(spark, sf_dir)), key="doc_id")


@register(
    "is_punctuation",
    O.doc_vocab_with(" SELECT token, token IN ('.', ',', '!', '?', ';', ':') AS is_punct FROM vocab"),
)
def q_is_punctuation(spark, sf_dir):
    return tk.is_punctuation(doc_vocab(spark, sf_dir).select("token"))


@register("encode", O.doc_vocab_with(f" {O.encode_cte('documents', 'doc_id', 'text')}"))
def q_encode(spark, sf_dir):
    return tk.encode(documents(spark, sf_dir), doc_vocab(spark, sf_dir))


@register("encode_frozen", O.doc_vocab_with(f" {O.encode_cte('benchmark', 'item_id', 'text', frozen=True)}"))
def q_encode_frozen(spark, sf_dir):
    return tk.encode_frozen(benchmark(spark, sf_dir), doc_vocab(spark, sf_dir), key="item_id")


@register(
    "ids_to_tokens",
    O.doc_vocab_with(
        f""", enc AS ({O.encode_cte('benchmark', 'item_id', 'text', frozen=True)}),
        e AS (SELECT item_id, unnest(generate_series(0, len(ids) - 1))::BIGINT AS pos, unnest(ids) AS token_id FROM enc)
        SELECT e.item_id, e.pos, e.token_id, coalesce(v.token, '<UNK>') AS token
        FROM e LEFT JOIN vocab v ON v.id = e.token_id"""
    ),
)
def q_ids_to_tokens(spark, sf_dir):
    vocab = doc_vocab(spark, sf_dir)
    enc = tk.encode_frozen(benchmark(spark, sf_dir), vocab, key="item_id")
    long = enc.select("item_id", F.posexplode("ids").alias("pos", "token_id")).withColumn("pos", F.col("pos").cast("bigint"))
    return tk.ids_to_tokens(long, vocab)


@register(
    "decode",
    O.doc_vocab_with(
        f""", enc AS ({O.encode_cte('documents', 'doc_id', 'text')}),
        seqs AS (SELECT doc_id AS seq_id, ids FROM enc)
        {O.decode_cte('seqs')}"""
    ),
)
def q_decode(spark, sf_dir):
    vocab = doc_vocab(spark, sf_dir)
    enc = tk.encode(documents(spark, sf_dir), vocab).withColumnRenamed("doc_id", "seq_id")
    return tk.decode(enc, vocab)


@register(
    "pad_sequence",
    O.doc_vocab_with(
        f""", enc AS ({O.encode_cte('documents', 'doc_id', 'text')})
        SELECT doc_id, list_resize(ids, 16, 0::BIGINT) AS padded FROM enc"""
    ),
)
def q_pad_sequence(spark, sf_dir):
    vocab = doc_vocab(spark, sf_dir)
    return tk.pad_sequence(tk.encode(documents(spark, sf_dir), vocab), 16).select("doc_id", "padded")


@register(
    "roundtrip_check",
    O.doc_vocab_with(
        f""", enc AS ({O.encode_cte('documents', 'doc_id', 'text', frozen=True)}),
        seqs AS (SELECT doc_id AS seq_id, ids FROM enc),
        dec AS ({O.decode_cte('seqs', out='decoded')}),
        ex AS (
          SELECT doc_id, coalesce((
            SELECT string_agg(CASE WHEN k > 1 AND w[k] NOT IN ('.', ',', '!', '?', ';', ':') THEN ' ' ELSE '' END || w[k], '' ORDER BY k)
            FROM range(1, len(w) + 1) r(k)), '') AS expected
          FROM ({O.words_cte()}))
        SELECT ex.doc_id, expected, decoded, expected = coalesce(decoded, '') AS same
        FROM ex LEFT JOIN dec ON dec.seq_id = ex.doc_id"""
    ),
)
def q_roundtrip_check(spark, sf_dir):
    return tk.roundtrip_check(documents(spark, sf_dir), doc_vocab(spark, sf_dir))


# ---------------------------------------------------------------- 2.3 vocabulary
@register("build_vocab", O.doc_vocab_with(" SELECT * FROM vocab"))
def q_build_vocab(spark, sf_dir):
    return doc_vocab(spark, sf_dir)


@register("vocab_table", O.doc_vocab_with(" SELECT token, id FROM vocab"))
def q_vocab_table(spark, sf_dir):
    return doc_vocab(spark, sf_dir).select("token", "id")


@register("vocab_size", O.doc_vocab_with(" SELECT count(*)::BIGINT AS vocab_size FROM vocab"))
def q_vocab_size(spark, sf_dir):
    return vc.vocab_size(doc_vocab(spark, sf_dir))


@register(
    "grow_vocab",
    O.doc_vocab_with(
        f""", btoks AS ({O.tokens_cte('benchmark', 'item_id')}),
        fresh AS (SELECT * FROM btoks WHERE token NOT IN (SELECT token FROM vocab))
        SELECT v.token, v.id, (v.n + coalesce(b.n, 0))::BIGINT AS n, v.first_doc, v.first_pos
        FROM vocab v LEFT JOIN (SELECT token, count(*) AS n FROM btoks GROUP BY token) b USING (token)
        UNION ALL {O.vocab_cte('fresh', 'item_id', start='(SELECT max(id) FROM vocab)')}"""
    ),
)
def q_grow_vocab(spark, sf_dir):
    vocab = doc_vocab(spark, sf_dir)
    return vc.grow_vocab(vocab, tk.count_tokens(benchmark(spark, sf_dir), key="item_id"), key="item_id")


@register(
    "token_counts",
    O.doc_vocab_with(
        f""", enc AS ({O.encode_cte('benchmark', 'item_id', 'text', frozen=True)})
        SELECT item_id, token_id, count(*)::BIGINT AS count FROM (SELECT item_id, unnest(ids) AS token_id FROM enc)
        GROUP BY item_id, token_id"""
    ),
)
def q_token_counts(spark, sf_dir):
    enc = tk.encode_frozen(benchmark(spark, sf_dir), doc_vocab(spark, sf_dir), key="item_id")
    return vc.token_counts(enc, key="item_id")


# ---------------------------------------------------------------- 2.1 cleaning
def pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select("page_id", "html")


def cleaned_pages(spark, sf_dir):
    from ..sources.clean import clean_articles

    return clean_articles(pages(spark, sf_dir), text="html", html=True, out="text").select("page_id", "text")


# Every document as a wiki page: links, templates, references, table, list and
# header lines around its text; every seventh redirects, every eleventh lists meanings.
def wiki_documents(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return d.select(F.col("doc_id").alias("page_id"), F.expr(WIKI_EXPR).alias("html"))


WIKI_EXPR = """concat(CASE WHEN doc_id % 7 = 0 THEN '#Redirect [[Main]] ' ELSE '' END,
    '{{Infobox ', coalesce(source, ''), '}}[[', coalesce(lang, 'x'), '|about ', coalesce(source, ''), ']] and [[Plain]]<ref name="a">note</ref> stays. ',
    coalesce(text, ''), chr(10), '| a | b |', chr(10), '* item', chr(10), '== Head ==', chr(10), ' See also this',
    CASE WHEN doc_id % 11 = 0 THEN ' may refer to:' ELSE '' END)"""


@register(
    "clean_articles",
    f"""SELECT 'page' AS kind, page_id, text FROM ({O.clean_pages_sql()})
    UNION ALL SELECT 'wiki', page_id, text FROM ({O.clean_pages_sql(f"(SELECT doc_id AS page_id, {WIKI_EXPR} AS html FROM documents)", False)})""",
)
def q_clean_articles(spark, sf_dir):
    from ..sources.clean import clean_articles

    wiki = clean_articles(wiki_documents(spark, sf_dir), text="html", html=False, out="text")
    kind = lambda df, name: df.select(F.lit(name).alias("kind"), "page_id", "text")
    return kind(cleaned_pages(spark, sf_dir), "page").unionByName(kind(wiki, "wiki"))


@register("limit_articles", f"SELECT * FROM ({O.clean_pages_sql()}) ORDER BY page_id LIMIT 100")
def q_limit_articles(spark, sf_dir):
    from ..sources.clean import limit_articles

    return limit_articles(cleaned_pages(spark, sf_dir), 100, key="page_id")


_WS_WORD = "[^\\t\\n\\x0B\\f\\r ]+"


@register(
    "corpus_stats",
    f"""SELECT n_docs, n_lines, n_words, n_tokens, n_lines >= 5 AS big_enough FROM (
      SELECT count(*)::BIGINT AS n_docs,
             coalesce(sum(len(string_split(text, chr(10)))), 0)::BIGINT AS n_lines,
             coalesce(sum(len(regexp_extract_all(text, '{_WS_WORD}'))), 0)::BIGINT AS n_words,
             coalesce(sum(len(regexp_extract_all(lower(text), '{O.PAT}')) + 2), 0)::BIGINT AS n_tokens
      FROM documents)""",
)
def q_corpus_stats(spark, sf_dir):
    from ..sources.clean import corpus_stats

    return corpus_stats(documents(spark, sf_dir))


def _audit_sql(stage: str, table: str) -> str:
    return f"""SELECT '{stage}' AS stage, table_lines, header_lines, table_lines > 5 OR header_lines > 5 AS warn FROM (
      SELECT coalesce(sum(regexp_matches(line, '^\\|.*\\|')::INT), 0)::BIGINT AS table_lines,
             coalesce(sum(regexp_matches(line, '^==')::INT), 0)::BIGINT AS header_lines
      FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM ({table})))"""


_WIKI_TABLE = f"(SELECT doc_id AS page_id, {WIKI_EXPR} AS html FROM documents)"


@register(
    "structural_audit",
    _audit_sql("raw", f"SELECT html AS text FROM {_WIKI_TABLE}")
    + " UNION ALL "
    + _audit_sql("cleaned", O.clean_pages_sql(_WIKI_TABLE, False)),
)
def q_structural_audit(spark, sf_dir):
    """The wiki pages before cleaning and after it."""
    from ..sources.clean import clean_articles, structural_audit

    wiki = wiki_documents(spark, sf_dir)
    clean = clean_articles(wiki, text="html", html=False, out="text")
    audit = lambda df, name: structural_audit(df).select(F.lit(name).alias("stage"), "*")
    return audit(wiki.withColumnRenamed("html", "text"), "raw").unionByName(audit(clean, "cleaned"))


# ---------------------------------------------------------------- 2.4 windows
def doc_seqs(spark, sf_dir, vocab=None):
    vocab = vocab if vocab is not None else doc_vocab(spark, sf_dir)
    return tk.encode(documents(spark, sf_dir), vocab).withColumnRenamed("doc_id", "seq_id")


def bench_seqs(spark, sf_dir, vocab=None):
    vocab = vocab if vocab is not None else doc_vocab(spark, sf_dir)
    return tk.encode_frozen(benchmark(spark, sf_dir), vocab, key="item_id").withColumnRenamed("item_id", "seq_id")


SAMPLE_K, SAMPLE_L, SEED = 1000, 10, 42


@register("next_token_windows", O.enc_docs_with(f" {O.windows_sql('seqs', 10)}"))
def q_next_token_windows(spark, sf_dir):
    from ..operators.windows import next_token_windows

    return next_token_windows(doc_seqs(spark, sf_dir), 10)


@register(
    "eval_windows",
    O.doc_vocab_with(
        f""", enc AS ({O.encode_cte('benchmark', 'item_id', 'text', frozen=True)}),
        seqs AS (SELECT item_id AS seq_id, ids FROM enc) {O.windows_sql('seqs', 20)}"""
    ),
)
def q_eval_windows(spark, sf_dir):
    from ..operators.windows import eval_windows

    return eval_windows(bench_seqs(spark, sf_dir))


def sampled(spark, sf_dir):
    from ..operators.windows import sample_text_windows

    docs = documents(spark, sf_dir).withColumnRenamed("doc_id", "seq_id")
    return sample_text_windows(docs, doc_vocab(spark, sf_dir), SAMPLE_K, SAMPLE_L, seed=SEED, epoch=0)


@register("sample_windows", O.enc_docs_with(f" {O.sample_sql('seqs', SAMPLE_K, SAMPLE_L, SEED, 0)}"))
def q_sample_windows(spark, sf_dir):
    return sampled(spark, sf_dir)


@register(
    "assign_batches",
    O.enc_docs_with(
        f" SELECT sample_no, seq_id, i, (sample_no // 32)::BIGINT AS batch FROM ({O.sample_sql('seqs', SAMPLE_K, SAMPLE_L, SEED, 0)})"
    ),
)
def q_assign_batches(spark, sf_dir):
    from ..operators.windows import assign_batches

    return assign_batches(sampled(spark, sf_dir), 32).select("sample_no", "seq_id", "i", "batch")


@register(
    "chunk_batches",
    O.enc_docs_with(
        f""" SELECT sample_no, seq_id, i, batch, (CASE WHEN size // 8 = 0 THEN 7
          ELSE least((sample_no - batch * 32) // (size // 8), 7) END)::BIGINT AS worker
        FROM (SELECT *, (sample_no // 32)::BIGINT AS batch, least(32, {SAMPLE_K} - (sample_no // 32) * 32) AS size
              FROM ({O.sample_sql('seqs', SAMPLE_K, SAMPLE_L, SEED, 0)}))"""
    ),
)
def q_chunk_batches(spark, sf_dir):
    from ..operators.windows import chunk_batches

    return chunk_batches(sampled(spark, sf_dir), 32, 8, SAMPLE_K).select("sample_no", "seq_id", "i", "batch", "worker")


@register(
    "training_plan",
    f"""SELECT n_tokens, 10::BIGINT AS max_seq_len, least(n_tokens // 20, 1000)::BIGINT AS samples_per_epoch,
           32::BIGINT AS batch_size, ceil(least(n_tokens // 20, 1000) / 32)::BIGINT AS n_batches
    FROM (SELECT coalesce(sum(len(regexp_extract_all(lower(text), '{O.PAT}')) + 2), 0)::BIGINT AS n_tokens FROM documents)""",
)
def q_training_plan(spark, sf_dir):
    from ..operators.windows import training_plan
    from ..sources.clean import corpus_stats

    return training_plan(corpus_stats(documents(spark, sf_dir)), 0.001, 64, 8)


# ---------------------------------------------------------------- 2.5 matrices
def emb_matrix(spark, sf_dir):
    from ..operators.matrix import matrix_from_rows

    return matrix_from_rows(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def emb_random(spark, sf_dir, E):
    from ..operators.matrix import matrix_random, matrix_shape

    r, c = matrix_shape(E)
    return matrix_random(spark, r, c, 7, "random")


def _mx(expr: str, body: str) -> str:
    return f"WITH {O.E_CTE}{expr} {body}"


RAND = f", R AS ({O.random_cells_sql(7, 'random')})"


@register("matrix_from_rows", _mx("", "SELECT i, j, v FROM E"))
def q_matrix_from_rows(spark, sf_dir):
    return emb_matrix(spark, sf_dir)


def label_shapes(spark, sf_dir):
    """One matrix per label of the embeddings, as many rows as it has vectors."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.groupBy(F.col("label").cast("bigint").alias("m")).agg(
        F.count("*").alias("rows"), F.max(F.size("embedding")).cast("bigint").alias("cols")
    )


LABEL_CELLS = """LS AS (SELECT label::BIGINT AS m, count(*) AS r, max(len(embedding)) AS c FROM embeddings GROUP BY label),
    LC AS (SELECT m, r, c, i, unnest(range(c)) AS j FROM (SELECT m, r, c, unnest(range(r)) AS i FROM LS))"""


def _label_draw(name: str) -> str:
    from ..functions.random import hash_uniform_sql

    return f"({hash_uniform_sql(7, name, 'm', 'i', 'j')} * 2.0 - 1.0)"


@register("matrix_zeros", f"WITH {LABEL_CELLS} SELECT m, i, j, 0.0::DOUBLE AS v FROM LC")
def q_matrix_zeros(spark, sf_dir):
    from ..operators.matrix import zeros_of

    return zeros_of(label_shapes(spark, sf_dir), ["m"])


@register("matrix_random", f"WITH {LABEL_CELLS} SELECT m, i, j, {_label_draw('random')} AS v FROM LC")
def q_matrix_random(spark, sf_dir):
    from ..operators.matrix import random_of

    return random_of(label_shapes(spark, sf_dir), ["m"], 7, "random")


@register(
    "matrix_xavier",
    f"WITH {LABEL_CELLS} SELECT m, i, j, {O.q6(_label_draw('xavier') + ' * sqrt(6.0 / (r + c))')} AS v FROM LC",
)
def q_matrix_xavier(spark, sf_dir):
    from ..operators.matrix import q6, xavier_of

    return xavier_of(label_shapes(spark, sf_dir), ["m"], 7, "xavier").withColumn("v", q6(F.col("v")))


UPD_SQL = "SELECT vec_id::BIGINT AS i, (label * 8)::BIGINT AS j, -1.0::DOUBLE AS v FROM embeddings"


def emb_updates(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("bigint").alias("i"), (F.col("label") * 8).cast("bigint").alias("j"), F.lit(-1.0).alias("v")
    )


@register("matrix_set", _mx(f", U AS ({UPD_SQL})", "SELECT E.i, E.j, coalesce(U.v, E.v) AS v FROM E LEFT JOIN U ON U.i = E.i AND U.j = E.j"))
def q_matrix_set(spark, sf_dir):
    from ..operators.matrix import matrix_set

    return matrix_set(emb_matrix(spark, sf_dir), emb_updates(spark, sf_dir))


@register("matrix_get", _mx(f", U AS ({UPD_SQL})", "SELECT U.i, U.j, coalesce(E.v, 0.0) AS v FROM U LEFT JOIN E ON U.i = E.i AND U.j = E.j"))
def q_matrix_get(spark, sf_dir):
    from ..operators.matrix import matrix_get

    return matrix_get(emb_matrix(spark, sf_dir), emb_updates(spark, sf_dir).select("i", "j"))


@register(
    "matrix_multiply",
    f"""WITH EM AS (SELECT label::BIGINT AS m, vec_id::BIGINT AS i, unnest(generate_series(0, len(embedding) - 1))::BIGINT AS j,
      unnest(embedding)::DOUBLE AS v FROM embeddings)
    SELECT a.m, a.j AS i, b.j AS j, {O.q6('sum(a.v * b.v)')} AS v FROM EM a JOIN EM b ON a.m = b.m AND a.i = b.i GROUP BY a.m, a.j, b.j""",
)
def q_matrix_multiply(spark, sf_dir):
    """E'E of every label's vectors: many matrices in one call."""
    from ..operators.matrix import matrix_multiply, matrix_transpose, q6

    e = read_table(spark, sf_dir, "embeddings")
    cells = e.select(
        F.col("label").cast("bigint").alias("m"), F.col("vec_id").cast("bigint").alias("i"), F.posexplode("embedding").alias("j", "v")
    ).select("m", "i", F.col("j").cast("bigint").alias("j"), F.col("v").cast("double").alias("v"))
    return matrix_multiply(matrix_transpose(cells, ["m"]), cells, key=["m"]).select("m", "i", "j", q6(F.col("v")).alias("v"))


@register("matrix_add", _mx(RAND, "SELECT i, j, coalesce(E.v, 0.0) + coalesce(R.v, 0.0) AS v FROM E FULL JOIN R USING (i, j)"))
def q_matrix_add(spark, sf_dir):
    from ..operators.matrix import matrix_add

    E = emb_matrix(spark, sf_dir)
    return matrix_add(E, emb_random(spark, sf_dir, E))


@register("matrix_hadamard", _mx(RAND, "SELECT i, j, coalesce(E.v, 0.0) * coalesce(R.v, 0.0) AS v FROM E FULL JOIN R USING (i, j)"))
def q_matrix_hadamard(spark, sf_dir):
    from ..operators.matrix import matrix_hadamard

    E = emb_matrix(spark, sf_dir)
    return matrix_hadamard(E, emb_random(spark, sf_dir, E))


@register("matrix_scale", _mx("", "SELECT i, j, v * 2.5 AS v FROM E"))
def q_matrix_scale(spark, sf_dir):
    from ..operators.matrix import matrix_scale

    return matrix_scale(emb_matrix(spark, sf_dir), 2.5)


@register("matrix_transpose", _mx("", "SELECT j AS i, i AS j, v FROM E"))
def q_matrix_transpose(spark, sf_dir):
    from ..operators.matrix import matrix_transpose

    return matrix_transpose(emb_matrix(spark, sf_dir))


@register("matrix_apply", _mx("", "SELECT i, j, v * v - v AS v FROM E"))
def q_matrix_apply(spark, sf_dir):
    from ..operators.matrix import matrix_apply

    return matrix_apply(emb_matrix(spark, sf_dir), lambda v: v * v - v)


@register("relu", _mx("", "SELECT i, j, CASE WHEN v > 0 THEN v ELSE 0.0 END AS v FROM E"))
def q_relu(spark, sf_dir):
    from ..operators.matrix import matrix_relu

    return matrix_relu(emb_matrix(spark, sf_dir))


@register("sigmoid", _mx("", f"SELECT i, j, {O.q6('1.0 / (1.0 + exp(-v))')} AS v FROM E"))
def q_sigmoid(spark, sf_dir):
    from ..operators.matrix import matrix_sigmoid, q6

    return matrix_sigmoid(emb_matrix(spark, sf_dir)).select("i", "j", q6(F.col("v")).alias("v"))


@register("tanh", _mx("", f"SELECT i, j, {O.q6('tanh(v)')} AS v FROM E"))
def q_tanh(spark, sf_dir):
    from ..operators.matrix import matrix_tanh, q6

    return matrix_tanh(emb_matrix(spark, sf_dir)).select("i", "j", q6(F.col("v")).alias("v"))


GELU_SQL = "0.5 * v * (1.0 + tanh(sqrt(2.0 / pi()) * (v + 0.044715 * v * v * v)))"


@register("gelu", _mx("", f"SELECT i, j, {O.q6(GELU_SQL)} AS v FROM E"))
def q_gelu(spark, sf_dir):
    from ..operators.matrix import matrix_gelu, q6

    return matrix_gelu(emb_matrix(spark, sf_dir)).select("i", "j", q6(F.col("v")).alias("v"))


@register(
    "row_softmax",
    _mx("", f"""SELECT i, j, {O.q6('e / sum(e) OVER (PARTITION BY i)')} AS v FROM (
        SELECT i, j, exp(v - max(v) OVER (PARTITION BY i)) AS e FROM E)"""),
)
def q_row_softmax(spark, sf_dir):
    from ..operators.matrix import q6, row_softmax

    return row_softmax(emb_matrix(spark, sf_dir)).select("i", "j", q6(F.col("v")).alias("v"))


@register(
    "row_layer_norm",
    _mx("", f"""SELECT i, j, {O.q6('(v - avg(v) OVER (PARTITION BY i)) / sqrt(var_pop(v) OVER (PARTITION BY i) + 1e-6)')} AS v FROM E"""),
)
def q_row_layer_norm(spark, sf_dir):
    from ..operators.matrix import q6, row_layer_norm

    return row_layer_norm(emb_matrix(spark, sf_dir), 1e-6).select("i", "j", q6(F.col("v")).alias("v"))


def _dropout_sql():
    from ..functions.random import hash_uniform_sql

    u = hash_uniform_sql(7, "dropout", "i", "j")
    return _mx("", f"SELECT i, j, CASE WHEN {u} > 0.1 THEN v * {1.0 / (1.0 - 0.1)!r} ELSE 0.0 END AS v FROM E")


@register("dropout", _dropout_sql())
def q_dropout(spark, sf_dir):
    from ..operators.matrix import dropout

    return dropout(emb_matrix(spark, sf_dir), 0.1, True, seed=7)


# ---------------------------------------------------------------- 2.7 decoding
DEC_V, PEN, NGRAM, TEMP, TOPK, TOPP = 64, 1.2, 3, 0.8, 50, 0.9


def dec_scores(spark, sf_dir):
    """softmax(8 x) of each embedding row: one score row per (vec_id, dim),
    quantised to 9 decimals."""
    from ..operators.matrix import matrix_scale, row_softmax

    E = emb_matrix(spark, sf_dir)
    sm = row_softmax(matrix_scale(E, 8.0))
    return sm.select(F.col("i").alias("seq_id"), F.col("j").alias("token_id"), (F.round(F.col("v") * 1e9) / 1e9 + 0.0).alias("p"))


def dec_hist(spark, sf_dir):
    """A history per row derived from its values: floor((x + 1) 32) in dim order."""
    from ..operators.decoding import history_arrays

    E = emb_matrix(spark, sf_dir)
    gen = E.select(F.col("i").alias("seq_id"), F.col("j").alias("pos"), F.floor((F.col("v") + 1.0) * 32).cast("bigint").alias("token_id"))
    return history_arrays(gen)


def _out(df):
    from ..operators.matrix import q6

    return df.select("seq_id", "token_id", q6(F.col("p")).alias("p"))


DEC_BASE = f"""WITH {O.E_CTE},
    S AS (SELECT i AS seq_id, j AS token_id, round(e / sum(e) OVER (PARTITION BY i) * 1e9) / 1e9 + 0.0 AS p
          FROM (SELECT i, j, exp(8.0 * v - max(8.0 * v) OVER (PARTITION BY i)) AS e FROM E)),
    HA AS (SELECT i AS seq_id, list(floor((v + 1.0) * 32)::BIGINT ORDER BY j) AS hist FROM E GROUP BY i)"""


def renorm_sql(x: str, v: str = "64.0") -> str:
    w = "OVER (PARTITION BY seq_id)"
    return f"(CASE WHEN sum({x}) {w} = 0 THEN 1.0 / {v} ELSE {x} / sum({x}) {w} END)"


def q6s(x: str) -> str:
    return O.q6(x)


PEN_SQL = f"""P1 AS (SELECT seq_id, token_id,
        CASE WHEN c > 2 THEN greatest(p / pow({PEN}, c - 1), 0.001) ELSE p END AS p
      FROM (SELECT S.seq_id, token_id, p, len(list_filter(coalesce(hist, []), lambda x: x = token_id)) AS c
            FROM S LEFT JOIN HA USING (seq_id)))"""


@register("normalize_scores", f"{DEC_BASE} SELECT seq_id, token_id, {q6s(renorm_sql('p'))} AS p FROM S")
def q_normalize_scores(spark, sf_dir):
    from ..operators.decoding import normalize_scores

    return _out(normalize_scores(dec_scores(spark, sf_dir), vocab_size=DEC_V))


@register("repetition_penalty", f"{DEC_BASE}, {PEN_SQL} SELECT seq_id, token_id, {q6s(renorm_sql('p'))} AS p FROM P1")
def q_repetition_penalty(spark, sf_dir):
    from ..operators.decoding import repetition_penalty

    return _out(repetition_penalty(dec_scores(spark, sf_dir), dec_hist(spark, sf_dir), PEN, vocab_size=DEC_V))


def ngram_sql(src: str, n: int) -> str:
    blocked = (
        f"list_transform(list_filter(range(0, len(hist) - {n} + 1), "
        f"lambda s: hist[s + 1 : s + {n - 1}] = hist[len(hist) - {n} + 2 : len(hist)]), lambda s: hist[s + {n}])"
    )
    recent = f"len(list_filter(hist[greatest(len(hist) - {O_RECENT - 1}, 1) : len(hist)], lambda x: x = token_id))"
    return f"""SELECT seq_id, token_id, p, short,
          CASE WHEN rc > 0 THEN pp * (1.0 / (1.0 + rc * 0.3)) ELSE pp * 1.3 END AS q FROM (
        SELECT seq_id, token_id, p, len(hist) < {n} AS short, {recent} AS rc,
               CASE WHEN list_contains({blocked}, token_id) THEN p * 0.02 ELSE p END AS pp
        FROM (SELECT {src}.seq_id, token_id, p, coalesce(hist, []) AS hist FROM {src} LEFT JOIN HA USING (seq_id)))"""


O_RECENT = 15


@register(
    "ngram_filter",
    f"""{DEC_BASE}, N1 AS ({ngram_sql('S', NGRAM)})
    SELECT seq_id, token_id, {q6s(f"CASE WHEN short THEN p ELSE {renorm_sql('q')} END")} AS p FROM N1""",
)
def q_ngram_filter(spark, sf_dir):
    from ..operators.decoding import ngram_filter

    return _out(ngram_filter(dec_scores(spark, sf_dir), dec_hist(spark, sf_dir), NGRAM, vocab_size=DEC_V))


TEMP_SQL = f"T1 AS (SELECT seq_id, token_id, {renorm_sql(f'pow(p, {1.0 / TEMP!r})')} AS p FROM S)"


@register("temperature", f"{DEC_BASE}, {TEMP_SQL} SELECT seq_id, token_id, {q6s('p')} AS p FROM T1")
def q_temperature(spark, sf_dir):
    from ..operators.decoding import temperature

    return _out(temperature(dec_scores(spark, sf_dir), TEMP, vocab_size=DEC_V))


def topk_sql(src: str, k: int) -> str:
    x = f"CASE WHEN row_number() OVER (PARTITION BY seq_id ORDER BY p DESC, token_id) <= {k} THEN p ELSE 0.0 END"
    return f"SELECT seq_id, token_id, {renorm_sql('x')} AS p FROM (SELECT seq_id, token_id, {x} AS x FROM {src})"


def topp_sql(src: str, pt: float) -> str:
    before = "coalesce(sum(p) OVER (PARTITION BY seq_id ORDER BY p DESC, token_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)"
    return f"SELECT seq_id, token_id, {renorm_sql('x')} AS p FROM (SELECT seq_id, token_id, CASE WHEN {before} < {pt} THEN p ELSE 0.0 END AS x FROM {src})"


@register("top_k", f"{DEC_BASE}, K1 AS ({topk_sql('S', TOPK)}) SELECT seq_id, token_id, {q6s('p')} AS p FROM K1")
def q_top_k(spark, sf_dir):
    from ..operators.decoding import top_k

    return _out(top_k(dec_scores(spark, sf_dir), TOPK, DEC_V))


@register("top_p", f"{DEC_BASE}, K1 AS ({topp_sql('S', TOPP)}) SELECT seq_id, token_id, {q6s('p')} AS p FROM K1")
def q_top_p(spark, sf_dir):
    from ..operators.decoding import top_p

    return _out(top_p(dec_scores(spark, sf_dir), TOPP, vocab_size=DEC_V))


@register("greedy_pick", f"{DEC_BASE} SELECT seq_id, first(token_id ORDER BY p DESC, token_id) AS token_id FROM S GROUP BY seq_id")
def q_greedy_pick(spark, sf_dir):
    from ..operators.decoding import greedy_pick

    return greedy_pick(dec_scores(spark, sf_dir))


def hash_sample_sql(src: str, v: int) -> str:
    return f"""SELECT seq_id, coalesce(min(CASE WHEN cum >= r THEN token_id END), {v - 1})::BIGINT AS token_id FROM (
      SELECT seq_id, token_id,
             sum(q) OVER (PARTITION BY seq_id ORDER BY token_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             ((((sum(floor(q * 1000000)) OVER (PARTITION BY seq_id) + {17 * v * (v - 1) // 2})::BIGINT % 4294967296) * 1664525 + 1013904223) % 4294967296) / 4294967296.0 AS r
      FROM (SELECT seq_id, token_id, round({renorm_sql('p', str(float(v)))} * 1e9) / 1e9 AS q FROM {src}))
    GROUP BY seq_id"""


@register("hash_sample", f"{DEC_BASE} {hash_sample_sql('S', DEC_V)}")
def q_hash_sample(spark, sf_dir):
    from ..operators.decoding import hash_sample

    return hash_sample(dec_scores(spark, sf_dir), vocab_size=DEC_V)


@register(
    "sample_next",
    f"""{DEC_BASE}, {TEMP_SQL}, K1 AS ({topk_sql('T1', TOPK)}), P1 AS ({topp_sql('K1', TOPP)})
    {hash_sample_sql('P1', DEC_V)}""",
)
def q_sample_next(spark, sf_dir):
    from ..operators.decoding import sample_next

    return sample_next(dec_scores(spark, sf_dir), TEMP, TOPK, TOPP, DEC_V)


def _rep_sql(a: str, w: int = 4) -> str:
    return f"(len({a}) >= {2 * w} AND {a}[len({a}) - {w - 1} : len({a})] = {a}[len({a}) - {2 * w - 1} : len({a}) - {w}])"


HIST_BASE = f"WITH {O.E_CTE}, HA AS (SELECT i AS seq_id, list(floor((v + 1.0) * 32)::BIGINT ORDER BY j) AS ids FROM E WHERE j < 8 + i % 57 GROUP BY i)"


def hist_seqs(spark, sf_dir):
    """Histories of varying length (8 + i mod 57 ids) so that the suffix test
    sees short, long, repeating and non-repeating sequences."""
    from ..operators.decoding import history_arrays

    E = emb_matrix(spark, sf_dir)
    gen = E.where(F.col("j") < F.lit(8) + F.col("i") % 57).select(
        F.col("i").alias("seq_id"), F.col("j").alias("pos"), F.floor((F.col("v") + 1.0) * 32).cast("bigint").alias("token_id")
    )
    return history_arrays(gen).withColumnRenamed("hist", "ids")


@register("repetitive_suffix", f"{HIST_BASE} SELECT seq_id, {_rep_sql('ids')} AS repetitive FROM HA")
def q_repetitive_suffix(spark, sf_dir):
    from ..operators.decoding import repetitive_suffix

    return repetitive_suffix(hist_seqs(spark, sf_dir)).select("seq_id", "repetitive")


@register(
    "stop_flags",
    f"""{HIST_BASE} SELECT seq_id, rep AS repetitive, len(ids) >= 40 AS too_long, ids[len(ids)] = 3 AS at_eos,
      rep OR len(ids) >= 40 OR ids[len(ids)] = 3 AS stop FROM (SELECT seq_id, ids, {_rep_sql('ids')} AS rep FROM HA)""",
)
def q_stop_flags(spark, sf_dir):
    from ..operators.decoding import stop_flags

    return stop_flags(hist_seqs(spark, sf_dir), 40).select("seq_id", "repetitive", "too_long", "at_eos", "stop")


# ---------------------------------------------------------------- 2.1/2.6 model tables
MD, MH, ML, MSEED = 16, 32, 1, 42


def model_parts(spark, sf_dir):
    from ..operators.params import ModelShape, init_params
    from ..session import cut_lineage

    vocab = cut_lineage(doc_vocab(spark, sf_dir))
    shape = ModelShape(vocab.count(), MD, MH, ML)
    # fresh weights are a pure function of (seed, name, row, column): cached for
    # reuse within the query (a lost block is recomputed exactly), not checkpointed
    params = init_params(spark, shape, MSEED).persist(StorageLevel.MEMORY_AND_DISK)
    return vocab, shape, params


def _q6vec(df, col="vec"):
    return df.withColumn(col, F.transform(col, lambda x: F.round(x * 1e6) / 1e6 + 0.0))


MODEL_WITH = O.doc_vocab_with(f""", VV AS (SELECT count(*) AS vs FROM vocab), PR AS ({O.init_params_sql('VV.vs', MD, MH, ML, MSEED)})""")


@register(
    "init_params",
    f"""{MODEL_WITH} SELECT param, row_id, v.token, {O.q6_list('vec')} AS vec FROM PR
    LEFT JOIN vocab v ON v.id = row_id AND param IN ('embedding', 'output_layer')""",
)
def q_init_params(spark, sf_dir):
    from ..operators.params import named_rows

    vocab, _, params = model_parts(spark, sf_dir)
    return _q6vec(named_rows(params, vocab))


TRAINED = """WITH EP AS (SELECT 'label_' || label AS param, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS row_id,
    embedding::DOUBLE[] AS vec FROM embeddings)"""


@register(
    "write_params",
    f"""{TRAINED} SELECT param, row_id, vec, list_transform(vec, lambda x: x * 0.5) AS m, list_transform(vec, lambda x: x * x) AS v,
    7::BIGINT AS step FROM EP""",
)
def q_write_params(spark, sf_dir):
    """A state of the embeddings' values, with moments, written and read back."""
    from ..session import scratch_path
    from ..sources.store import write_state

    path = write_state(emb_state(spark, sf_dir), scratch_path(spark, "params"), step=7)
    meta = spark.read.parquet(f"{path}/meta")
    return spark.read.parquet(f"{path}/weights").select("param", "row_id", "vec", "m", "v").join(meta.select("step"))


def emb_state(spark, sf_dir):
    return emb_params(spark, sf_dir).withColumns(
        {"m": F.transform("vec", lambda x: x * 0.5), "v": F.transform("vec", lambda x: x * x)}
    )


@register(
    "read_params",
    f"""{TRAINED}, LAST AS (SELECT max(param) AS gone FROM EP)
    SELECT param, row_id, CASE WHEN param = gone THEN list_transform(vec, lambda x: 0.0) ELSE vec END AS vec,
      CASE WHEN param = gone THEN list_transform(vec, lambda x: 0.0) ELSE list_transform(vec, lambda x: x * 0.5) END AS m,
      CASE WHEN param = gone THEN list_transform(vec, lambda x: 0.0) ELSE list_transform(vec, lambda x: x * x) END AS v
    FROM EP, LAST""",
)
def q_read_params(spark, sf_dir):
    """The same state read over zeros: one tensor was written with a row too few
    and keeps its initial values."""
    from ..session import scratch_path
    from ..sources.store import read_state, write_state

    state = emb_state(spark, sf_dir)
    gone = state.agg(F.max("param")).first()[0]
    path = write_state(state.where(~((F.col("param") == gone) & (F.col("row_id") == 0))), scratch_path(spark, "params"), step=7)
    zero = lambda c: F.transform(c, lambda x: F.lit(0.0))
    initial = state.withColumns({c: zero(c) for c in ("vec", "m", "v")})
    return read_state(spark, path, initial)


def emb_params(spark, sf_dir):
    """The embeddings as a parameter table: one matrix per label, its rows in
    the order of their ids."""
    from pyspark.sql import Window

    e = read_table(spark, sf_dir, "embeddings")
    place = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    return e.select(
        F.concat(F.lit("label_"), F.col("label")).alias("param"), place.cast("bigint").alias("row_id"),
        F.col("embedding").cast("array<double>").alias("vec"),
    )


EMB_PARAMS = """EP AS (SELECT 'label_' || label AS param, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS row_id,
    embedding::DOUBLE[] AS vec FROM embeddings)"""


@register(
    "flatten_matrix",
    f"""WITH {EMB_PARAMS} SELECT param, row_id * len(vec) + j AS k, v FROM (
      SELECT param, row_id, vec, unnest(generate_series(0, len(vec) - 1)) AS j, unnest(vec) AS v FROM EP)""",
)
def q_flatten_matrix(spark, sf_dir):
    from ..operators.params import flatten_all

    return flatten_all(emb_params(spark, sf_dir))


@register("unflatten_matrix", f"WITH {EMB_PARAMS} SELECT param, row_id, vec FROM EP")
def q_unflatten_matrix(spark, sf_dir):
    from ..operators.params import flatten_all, unflatten_all

    params = emb_params(spark, sf_dir)
    shapes = params.groupBy("param").agg(F.count("*").alias("rows"), F.max(F.size("vec")).alias("cols"))
    return unflatten_all(flatten_all(params), shapes)


@register("write_vocab", O.doc_vocab_with(" SELECT * FROM vocab"))
def q_write_vocab(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.store import write_vocab

    path = write_vocab(doc_vocab(spark, sf_dir), scratch_path(spark, "vocab"))
    return spark.read.parquet(path)


@register("read_vocab", O.doc_vocab_with(" SELECT * FROM vocab"))
def q_read_vocab(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.store import read_vocab, write_vocab

    path = write_vocab(doc_vocab(spark, sf_dir), scratch_path(spark, "vocab"))
    return read_vocab(spark, path)


# relational layers over every evaluation window of the benchmark texts
def layer_input(spark, sf_dir):
    from ..operators.windows import eval_windows

    vocab, shape, params = model_parts(spark, sf_dir)
    w = eval_windows(bench_seqs(spark, sf_dir, vocab))
    toks = w.select(
        F.concat_ws(":", "seq_id", "i").alias("seq_id"), F.posexplode("input").alias("pos", "token_id")
    ).withColumn("pos", F.col("pos").cast("bigint"))
    return toks, shape, params


def model_with(seqs: str, tokens: str) -> str:
    """WITH vocab, PR, seqs, the caller's TK, and the layers over TK."""
    return O.doc_vocab_with(
        f""", VV AS (SELECT count(*) AS vs FROM vocab),
    PR AS MATERIALIZED ({O.init_params_sql('VV.vs', MD, MH, ML, MSEED)}),
    {seqs}, {tokens}, {O.layers_sql(MD, 4)}"""
    )


BENCH_SEQS = f"enc AS ({O.encode_cte('benchmark', 'item_id', 'text', frozen=True)}), seqs AS (SELECT item_id AS seq_id, ids FROM enc)"
BENCH_WINDOWS = f"""WN AS MATERIALIZED ({O.windows_sql('seqs', 20)}),
    TK AS (SELECT concat_ws(':', seq_id, i) AS seq_id, unnest(generate_series(0, len(input) - 1))::BIGINT AS pos, unnest(input) AS token_id FROM WN)"""
WHOLE_SEQS = "TK AS (SELECT seq_id, unnest(generate_series(0, len(ids) - 1))::BIGINT AS pos, unnest(ids) AS token_id FROM seqs)"
LAYER_WITH = model_with(BENCH_SEQS, BENCH_WINDOWS)


def _xout(df):
    return df.select("seq_id", "pos", F.col("k").cast("bigint").alias("k"), (F.round(F.col("x") * 1e6) / 1e6 + 0.0).alias("x"))


XOUT = "SELECT seq_id, pos, k, round(x * 1e6) / 1e6 + 0.0 AS x FROM"


@register("embed_tokens", f"{LAYER_WITH} {XOUT} X0")
def q_embed_tokens(spark, sf_dir):
    from ..operators.layers import embed_tokens

    toks, shape, params = layer_input(spark, sf_dir)
    return _xout(embed_tokens(toks, params, shape))


@register(
    "positional_table",
    f"""{LAYER_WITH} SELECT t.seq_id, t.pos, token_id, list({O.q6('coalesce(pe, 0.0)')} ORDER BY d.range) AS vec
    FROM TK t CROSS JOIN range({MD}) d LEFT JOIN PE ON PE.pos = t.pos AND PE.k = d.range GROUP BY ALL""",
)
def q_positional_table(spark, sf_dir):
    """The position vector of every token of every evaluation window."""
    from ..operators.layers import position_vectors

    toks, shape, _ = layer_input(spark, sf_dir)
    return _q6vec(position_vectors(toks, shape.max_seq_len, shape.embed_size))


def _x1(spark, sf_dir):
    from ..operators.layers import add_positions, embed_tokens, positional_table

    toks, shape, params = layer_input(spark, sf_dir)
    x1 = add_positions(embed_tokens(toks, params, shape), positional_table(spark, shape.max_seq_len, shape.embed_size))
    return x1, shape, params


def _n1(spark, sf_dir):
    from ..operators.layers import layer_norm_affine, vector_cells

    x1, shape, params = _x1(spark, sf_dir)
    n1 = layer_norm_affine(x1, vector_cells(params, "transformer_0_ln1_gamma"), vector_cells(params, "transformer_0_ln1_beta"), shape.eps)
    return n1, shape, params


@register("add_positions", f"{LAYER_WITH} {XOUT} X1")
def q_add_positions(spark, sf_dir):
    return _xout(_x1(spark, sf_dir)[0])


@register("layer_norm_affine", f"{LAYER_WITH} {XOUT} N1")
def q_layer_norm_affine(spark, sf_dir):
    return _xout(_n1(spark, sf_dir)[0])


@register("causal_attention", f"{LAYER_WITH} {XOUT} ATT")
def q_causal_attention(spark, sf_dir):
    from ..operators.layers import causal_attention

    n1, shape, params = _n1(spark, sf_dir)
    return _xout(causal_attention(n1, params, 0, shape))


@register("feed_forward", f"{LAYER_WITH}, F1 AS ({O.ff_sql('N1', 0)}) {XOUT} F1")
def q_feed_forward(spark, sf_dir):
    from ..operators.layers import feed_forward

    n1, shape, params = _n1(spark, sf_dir)
    return _xout(feed_forward(n1, params, 0))


@register(
    "transformer_block",
    f"""{LAYER_WITH} SELECT seq_id, pos, list({O.q6('x')} ORDER BY k) AS vec FROM XB GROUP BY seq_id, pos""",
)
def q_transformer_block(spark, sf_dir):
    from ..operators.layers import block_rows

    x1, shape, params = _x1(spark, sf_dir)
    return _q6vec(block_rows(x1, params, 0, shape))


# ---------------------------------------------------------------- 2.6 scoring jobs
def _round(df, **digits):
    for name, n in digits.items():
        df = df.withColumn(name, F.round(F.col(name) * 10.0**n) / 10.0**n + 0.0)
    return df


@register(
    "forward_logits",
    f"""{model_with(BENCH_SEQS, WHOLE_SEQS)}, {O.states_sql(MD, every=True)},
    L AS (SELECT seq_id, pos, token_id, array_inner_product(h, w) AS l FROM H, W)
    SELECT seq_id, pos, arg_max(token_id, l) AS top_token, {O.q6('max(l)')} AS top_logit, {O.q6('ln(sum(exp(l)))')} AS lse
    FROM L GROUP BY seq_id, pos""",
)
def q_forward_logits(spark, sf_dir):
    from ..operators.scoring import forward_logits

    vocab, shape, params = model_parts(spark, sf_dir)
    return _round(forward_logits(bench_seqs(spark, sf_dir, vocab), params, shape, summary=True), top_logit=6, lse=6)


def user_prompts(spark, sf_dir, vocab):
    conv = read_table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    keyed = conv.select(F.concat_ws(":", "conv_id", "turn").alias("seq_id"), "text")
    return tk.encode_frozen(keyed, vocab, key="seq_id")


PROMPT_SEQS = f"""users AS (SELECT concat_ws(':', conv_id, turn) AS seq_id, text FROM conversations WHERE role = 'user'),
    seqs AS ({O.encode_cte("users", "seq_id", "text", frozen=True)})"""
PREDICT_TOP = 40


@register(
    "predict_next",
    f"""{model_with(PROMPT_SEQS, WHOLE_SEQS)}, {O.states_sql(MD)},
    L AS MATERIALIZED (SELECT seq_id, token_id, exp(array_inner_product(h, w)) AS e FROM H, W),
    Z AS (SELECT seq_id, sum(e) AS z FROM L GROUP BY seq_id),
    SEEN AS (SELECT DISTINCT seq_id, token_id FROM TK),
    BEST AS (SELECT seq_id, token_id, e FROM L ANTI JOIN SEEN USING (seq_id, token_id)
             QUALIFY row_number() OVER (PARTITION BY seq_id ORDER BY e DESC, token_id) <= {PREDICT_TOP})
    SELECT seq_id, token_id, {O.q9('e / z')} AS p
    FROM (SELECT * FROM BEST UNION ALL SELECT seq_id, token_id, e FROM L SEMI JOIN SEEN USING (seq_id, token_id)) JOIN Z USING (seq_id)""",
)
def q_predict_next(spark, sf_dir):
    from ..operators.scoring import predict_next

    vocab, shape, params = model_parts(spark, sf_dir)
    return _round(predict_next(user_prompts(spark, sf_dir, vocab), params, shape, top=PREDICT_TOP), p=9)


LOSS_WITH = f"""{LAYER_WITH}, {O.states_sql(MD)},
    Z AS MATERIALIZED (SELECT seq_id AS wid, sum(exp(array_inner_product(h, w))) AS z FROM H, W GROUP BY seq_id),
    LS AS MATERIALIZED (SELECT n.seq_id, n.i, n.target, coalesce(exp(array_inner_product(h, w)) / z, 0.0) AS p, w IS NULL AS out_of
           FROM WN n JOIN Z ON wid = concat_ws(':', n.seq_id, n.i) JOIN H ON H.seq_id = wid LEFT JOIN W ON token_id = target),
    LL AS (SELECT seq_id, i, target, p, CASE WHEN out_of THEN 0.0 ELSE -ln(p + 1e-10) END AS loss FROM LS)"""


@register("window_loss", f"{LOSS_WITH} SELECT seq_id, i, target, {O.q9('p')} AS p, {O.q6('loss')} AS loss FROM LL")
def q_window_loss(spark, sf_dir):
    from ..operators.scoring import window_loss
    from ..operators.windows import eval_windows

    vocab, shape, params = model_parts(spark, sf_dir)
    return _round(window_loss(eval_windows(bench_seqs(spark, sf_dir, vocab)), params, shape), p=9, loss=6)


@register(
    "evaluate",
    f"""{LOSS_WITH} SELECT count(*) AS n_windows, {O.q6('avg(loss)')} AS mean_loss,
    round(exp(avg(loss)) * 1e3) / 1e3 AS perplexity FROM LL""",
)
def q_evaluate(spark, sf_dir):
    from ..operators.scoring import evaluate

    vocab, shape, params = model_parts(spark, sf_dir)
    return _round(evaluate(bench_seqs(spark, sf_dir, vocab), params, shape), mean_loss=6, perplexity=3)


# ---------------------------------------------------------------- 2.8 training
def grad_batch(spark, sf_dir):
    from ..operators.gradients import adam_state
    from ..operators.windows import sample_windows
    from ..session import cut_lineage

    vocab, shape, params = model_parts(spark, sf_dir)
    seqs = cut_lineage(doc_seqs(spark, sf_dir, vocab))
    batch = cut_lineage(sample_windows(seqs, 64, 10, seed=SEED, epoch=0))
    return vocab, shape, adam_state(params), batch, seqs


_DOTS = ", ".join(f"sum(d * h[{k + 1}])" for k in range(MD))
_BACK = ", ".join(f"sum(d * w[{k + 1}])" for k in range(MD))


@register(
    "window_gradients",
    f"""{LOSS_WITH},
    D AS NOT MATERIALIZED (SELECT wid, token_id, exp(array_inner_product(h, w)) / z - CASE WHEN token_id = target THEN 1.0 ELSE 0.0 END AS d, h, w,
             input[len(input)] AS last
          FROM WN n JOIN Z ON wid = concat_ws(':', n.seq_id, n.i) JOIN H ON H.seq_id = wid, W)
    SELECT 'output_layer' AS param, token_id AS row_id, {O.q6_list(f'[{_DOTS}]')} AS vec FROM D GROUP BY token_id
    UNION ALL SELECT 'embedding', last, {O.q6_list(f'[{_BACK}]')} FROM D WHERE last < (SELECT vs FROM VV) GROUP BY last
    UNION ALL SELECT '__loss__', 0, {O.q6_list('[sum(loss), count(*)::DOUBLE]')} FROM LL""",
)
def q_window_gradients(spark, sf_dir):
    from ..operators.gradients import sum_gradients, window_gradients
    from ..operators.scoring import broadcast_model
    from ..operators.windows import eval_windows

    vocab, shape, params = model_parts(spark, sf_dir)
    batch = eval_windows(bench_seqs(spark, sf_dir, vocab))
    grads = window_gradients(batch, broadcast_model(params, shape), shape, "seq_id", training=False)
    return _q6vec(sum_gradients(grads))


def _step_sql() -> str:
    """One Adam step (t = 1, zero moments, no dropout) on 64 sampled windows."""
    from ..operators.gradients import AdamConfig, step_size, updated_params
    from ..operators.params import ModelShape

    c = AdamConfig()
    names = ", ".join(f"'{n}'" for n in updated_params(ModelShape(8, MD, MH, ML)))
    windows = f"WN AS MATERIALIZED ({O.sample_sql('seqs', BATCH, SAMPLE_L, SEED, 0)})"
    tokens = "TK AS (SELECT sample_no AS seq_id, unnest(generate_series(0, len(input) - 1))::BIGINT AS pos, unnest(input) AS token_id FROM WN)"
    seqs = f"enc AS ({O.encode_cte('documents', 'doc_id', 'text')}), seqs AS (SELECT doc_id AS seq_id, ids FROM enc)"
    g = f"coalesce(g[j], 0.0) * f / n + {c.weight_decay} * w[j]"
    moved = f"w[j] - {step_size(c, 1)!r} * ({1 - c.beta1!r} * ({g})) / (sqrt({1 - c.beta2!r} * ({g}) * ({g})) + {c.epsilon!r})"
    return f"""{model_with(seqs, windows + ", " + tokens)}, {O.states_sql(MD)},
    Z AS MATERIALIZED (SELECT seq_id AS wid, sum(exp(array_inner_product(h, w))) AS z FROM H, W GROUP BY seq_id),
    D AS MATERIALIZED (SELECT wid, token_id, h, w, target, exp(array_inner_product(h, w)) / z AS p,
             exp(array_inner_product(h, w)) / z - CASE WHEN token_id = target THEN 1.0 ELSE 0.0 END AS d, input[len(input)] AS last
          FROM WN JOIN Z ON wid = sample_no JOIN H ON H.seq_id = wid, W),
    G AS MATERIALIZED (SELECT 'output_layer' AS param, token_id AS row_id, [{_DOTS}] AS g FROM D GROUP BY token_id
          UNION ALL SELECT 'embedding', last, [{_BACK}] FROM D GROUP BY last),
    T AS (SELECT n, ls / n AS loss, sqrt(sq) / n AS norm, least(1.0, n / sqrt(sq)) AS f
          FROM (SELECT count(*) AS n FROM WN), (SELECT sum(-ln(p + 1e-10)) AS ls FROM D WHERE token_id = target),
            (SELECT sum(list_sum(list_transform(g, lambda x: x * x))) AS sq FROM G)),
    U AS (SELECT PR.param, PR.row_id, vec AS w, g, n, f FROM PR LEFT JOIN G ON G.param = PR.param AND G.row_id = PR.row_id, T)
    SELECT param, row_id, {O.q6_list(f"CASE WHEN param IN ({names}) THEN list_transform(range(1, len(w) + 1), lambda j: greatest(least({moved}, {c.clamp}), -{c.clamp})) ELSE w END")} AS vec FROM U
    UNION ALL SELECT '__step__', 0, {O.q6_list('[loss, norm]')} FROM T"""


BATCH = 64


@register("train_batch", _step_sql())
def q_train_batch(spark, sf_dir):
    """The parameters after one step, and a row with its loss and gradient norm."""
    from ..operators.gradients import adam_state
    from ..operators.windows import sample_text_windows
    from ..plans.train import TrainingConfig, train_batch

    vocab, shape, params = model_parts(spark, sf_dir)
    docs = documents(spark, sf_dir).withColumnRenamed("doc_id", "seq_id")
    batch = sample_text_windows(docs, vocab, BATCH, SAMPLE_L, seed=SEED, epoch=0)
    state, loss, norm = train_batch(adam_state(params), batch, shape, TrainingConfig(dropout=False), 1)
    step = spark.createDataFrame([("__step__", 0, [loss, norm])], "param string, row_id bigint, vec array<double>")
    return _q6vec(state.select("param", "row_id", "vec").unionByName(step))


TRAIN_CFG = dict(learning_rate=0.05, batch_size=64, workers=16, seed=SEED)


@register("train")
def q_train(spark, sf_dir):
    from ..operators.gradients import AdamConfig
    from ..plans.train import TrainingConfig, planned, token_count, train

    _, shape, state, _, seqs = grad_batch(spark, sf_dir)
    cfg = planned(TrainingConfig(adam=AdamConfig(learning_rate=0.05), **TRAIN_CFG), token_count(seqs))
    _, losses, _ = train(state, seqs, shape, cfg, 1)
    return losses


@register("train_from_corpus")
def q_train_from_corpus(spark, sf_dir):
    from ..operators.gradients import AdamConfig
    from ..plans.train import TrainingConfig, train_from_corpus
    from ..session import scratch_path

    cfg = TrainingConfig(adam=AdamConfig(learning_rate=0.05), **TRAIN_CFG)
    _, _, _, losses = train_from_corpus(
        documents(spark, sf_dir), dict(embed_size=MD, hidden_size=MH, num_layers=ML), cfg, 1, scratch_path(spark, "model"), by_plan=True
    )
    return losses


@register("generate_batch")
def q_generate_batch(spark, sf_dir):
    from ..plans.generate import CLI_PRESET, generate_batch

    vocab, shape, params = model_parts(spark, sf_dir)
    return generate_batch(user_prompts(spark, sf_dir, vocab), params, shape, CLI_PRESET)


# ---------------------------------------------------------------- 2.8 gradient algebra (SQL-checked)
def emb_hidden(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("seq_id"), F.col("embedding").cast("array<double>").alias("vec"), F.col("label").cast("bigint").alias("target")
    )


def grads_by(spark, sf_dir, token):
    from ..operators.gradients import embedding_gradient

    h = emb_hidden(spark, sf_dir)
    return embedding_gradient(h.select(token.alias("token_id"), "vec"))


def _glong(df, cols=("vec",), digits=6):
    from ..operators.gradients import to_long

    out = to_long(df).select(F.col("row_id").cast("bigint"), F.col("k").cast("bigint"), "g")
    return out.withColumn("g", F.round(F.col("g") * 10.0**digits) / 10.0**digits + 0.0)


EV = """EV AS (SELECT vec_id AS seq_id, embedding::DOUBLE[] AS vec, label::BIGINT AS target FROM embeddings),
    EL AS (SELECT seq_id, target, unnest(generate_series(0, len(vec) - 1))::BIGINT AS k, unnest(vec) AS x FROM EV)"""
G1 = "G1 AS (SELECT target AS row_id, k, sum(x) AS g FROM EL GROUP BY target, k)"


def gq(x: str, digits: int = 6) -> str:
    return f"round(({x}) * {10.0 ** digits!r}) / {10.0 ** digits!r} + 0.0"


@register(
    "output_gradient",
    f"""{DEC_BASE}, {EV}
    SELECT token_id AS row_id, k, {gq("sum((p - CASE WHEN token_id = target THEN 1.0 ELSE 0.0 END) * x)")} AS g
    FROM S JOIN EL USING (seq_id) GROUP BY token_id, k""",
)
def q_output_gradient(spark, sf_dir):
    from ..operators.gradients import output_gradient

    return _glong(output_gradient(dec_scores(spark, sf_dir), emb_hidden(spark, sf_dir)))


@register("embedding_gradient", f"WITH {EV}, {G1} SELECT row_id, k, {gq('g')} AS g FROM G1")
def q_embedding_gradient(spark, sf_dir):
    return _glong(grads_by(spark, sf_dir, F.col("target")))


@register(
    "zero_gradients",
    f"""WITH {EV}, {G1} SELECT e.seq_id AS row_id, e.k, {gq('coalesce(g.g, 0.0)')} AS g
    FROM EL e LEFT JOIN G1 g ON g.row_id = e.seq_id AND g.k = e.k""",
)
def q_zero_gradients(spark, sf_dir):
    from ..operators.gradients import zero_gradients

    params = emb_hidden(spark, sf_dir).select(F.lit("embedding").alias("param"), F.col("seq_id").alias("row_id"), "vec")
    return _glong(zero_gradients(params, grads_by(spark, sf_dir, F.col("target"))))


@register(
    "sum_gradients",
    f"""WITH {EV}, {G1}, G2 AS (SELECT target % 3 AS row_id, k, sum(x) AS g FROM EL GROUP BY target % 3, k)
    SELECT row_id, k, {gq('sum(g)')} AS g FROM (SELECT * FROM G1 UNION ALL SELECT * FROM G2) GROUP BY row_id, k""",
)
def q_sum_gradients(spark, sf_dir):
    from ..operators.gradients import sum_gradients

    return _glong(sum_gradients(grads_by(spark, sf_dir, F.col("target")), grads_by(spark, sf_dir, F.col("target") % 3)))


@register("scale_gradients", f"WITH {EV}, {G1} SELECT row_id, k, {gq('g * 0.5')} AS g FROM G1")
def q_scale_gradients(spark, sf_dir):
    from ..operators.gradients import scale_gradients

    return _glong(scale_gradients(grads_by(spark, sf_dir, F.col("target")), 0.5))


@register(
    "clip_gradients",
    f"""WITH {EV}, {G1}, NR AS (SELECT sqrt(sum(g * g)) AS norm FROM G1)
    SELECT row_id, k, {gq('CASE WHEN norm > 1.0 THEN g * (1.0 / norm) ELSE g END')} AS g FROM G1, NR""",
)
def q_clip_gradients(spark, sf_dir):
    from ..operators.gradients import clip_gradients

    clipped, _ = clip_gradients(grads_by(spark, sf_dir, F.col("target")), 1.0)
    return _glong(clipped)


@register("adam_state", f"WITH {EV} SELECT seq_id AS row_id, k, x AS w, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v FROM EL")
def q_adam_state(spark, sf_dir):
    from ..operators.gradients import adam_state

    params = emb_hidden(spark, sf_dir).select(F.lit("embedding").alias("param"), F.col("seq_id").alias("row_id"), "vec")
    st = adam_state(params)
    return st.select(F.col("row_id").cast("bigint"), F.posexplode(F.arrays_zip("vec", "m", "v")).alias("k", "c")).select(
        "row_id", F.col("k").cast("bigint"), F.col("c.vec").alias("w"), F.col("c.m").alias("m"), F.col("c.v").alias("v")
    )


def _adam_sql():
    from ..operators.gradients import AdamConfig, step_size

    c = AdamConfig()
    lr1 = step_size(c, 1)
    g = f"(coalesce(G1.g, 0.0) + {c.weight_decay!r} * x)"
    m = f"({c.beta1!r} * 0.0 + {1 - c.beta1!r} * {g})"
    v = f"({c.beta2!r} * 0.0 + {1 - c.beta2!r} * {g} * {g})"
    w = f"greatest(least(x - {lr1!r} * {m} / (sqrt({v}) + {c.epsilon!r}), 10.0), -10.0)"
    return f"""WITH {EV}, {G1} SELECT e.seq_id AS row_id, e.k, {gq(w)} AS w, {gq(m, 10)} AS m, {gq(v, 10)} AS v
    FROM EL e LEFT JOIN G1 ON G1.row_id = e.seq_id AND G1.k = e.k"""


@register("adam_step", _adam_sql())
def q_adam_step(spark, sf_dir):
    from ..operators.gradients import AdamConfig, adam_state, adam_step

    params = emb_hidden(spark, sf_dir).select(F.lit("embedding").alias("param"), F.col("seq_id").alias("row_id"), "vec")
    new = adam_step(adam_state(params), grads_by(spark, sf_dir, F.col("target")), 1, AdamConfig(), ["embedding"])
    cells = new.select(F.col("row_id").cast("bigint"), F.posexplode(F.arrays_zip("vec", "m", "v")).alias("k", "c"))
    r = lambda x, d: F.round(x * 10.0**d) / 10.0**d + 0.0
    return cells.select("row_id", F.col("k").cast("bigint"), r(F.col("c.vec"), 6).alias("w"), r(F.col("c.m"), 10).alias("m"), r(F.col("c.v"), 10).alias("v"))


STEPS_SQL = O.enc_docs_with(
    f""", ST AS (SELECT (sample_no // 32 + 1)::BIGINT AS t, count(*) AS windows, sum(len(input))::BIGINT AS tokens
    FROM ({O.sample_sql('seqs', SAMPLE_K, SAMPLE_L, SEED, 0)}) GROUP BY ALL)"""
)


def batch_steps(spark, sf_dir):
    """The steps of an epoch over the sampled windows: their number, windows and
    input tokens."""
    from ..operators.windows import assign_batches

    batches = assign_batches(sampled(spark, sf_dir), 32)
    return batches.groupBy((F.col("batch") + 1).alias("t")).agg(
        F.count("*").alias("windows"), F.sum(F.size("input")).cast("bigint").alias("tokens")
    )


@register(
    "effective_lr",
    f"{STEPS_SQL} SELECT t, windows, tokens, {gq('0.001 * sqrt(1.0 - pow(0.999, t)) / (1.0 - pow(0.9, t))', 12)} AS lr FROM ST",
)
def q_effective_lr(spark, sf_dir):
    from ..operators.gradients import effective_lr

    rate = F.round(effective_lr(0.001, F.col("t")) * 1e12) / 1e12 + 0.0
    return batch_steps(spark, sf_dir).withColumn("lr", rate)


@register(
    "warmup_lr",
    f"""{STEPS_SQL} SELECT t, windows, tokens, CASE WHEN t < 10 THEN 0.001::DOUBLE * t / 10.0::DOUBLE
      ELSE 0.001::DOUBLE * 9.0::DOUBLE / 10.0::DOUBLE END AS lr FROM ST""",
)
def q_warmup_lr(spark, sf_dir):
    from ..operators.gradients import warmup_lr

    return batch_steps(spark, sf_dir).withColumn("lr", warmup_lr(0.001, F.col("t"), 10))


# ---------------------------------------------------------------- 2.9 streaming
@register("stream_vocab", O.doc_vocab_with(" SELECT * FROM vocab"))
def q_stream_vocab(spark, sf_dir):
    from ..session import scratch_path
    from ..streaming.vocab_stream import stream_vocab, write_in_order

    base = scratch_path(spark, "stream")
    docs = documents(spark, sf_dir)
    # Files of some 5,000 documents, four at least, each a micro-batch.
    write_in_order(docs, f"{base}/source", max(4, -(-docs.count() // 5000)))
    return stream_vocab(spark, f"{base}/source", f"{base}/vocab", f"{base}/checkpoint")
