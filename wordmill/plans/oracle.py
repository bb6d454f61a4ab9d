"""DuckDB SQL texts equal to the registered queries (the correctness oracle).

Built from small CTE fragments so that each query states the same steps as
its Spark job.  Views named after the supplied tables are assumed.
"""

from __future__ import annotations

from ..functions.text import TOKEN_PATTERN

PAT = TOKEN_PATTERN  # backslashes are literal inside DuckDB strings

SPECIALS_SQL = """
    SELECT '<PAD>' AS token, 0::BIGINT AS id, 0::BIGINT AS n, NULL::BIGINT AS first_doc, NULL::BIGINT AS first_pos
    UNION ALL SELECT '<UNK>', 1, 0, NULL, NULL
    UNION ALL SELECT '<BOS>', 2, 0, NULL, NULL
    UNION ALL SELECT '<EOS>', 3, 0, NULL, NULL"""


def words_cte(table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    return f"SELECT {key}, regexp_extract_all(lower({text}), '{PAT}') AS w FROM {table}"


def tokens_cte(table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    return (
        f"SELECT {key}, unnest(generate_series(0, len(w) - 1))::BIGINT AS pos, unnest(w) AS token "
        f"FROM ({words_cte(table, key, text)})"
    )


def vocab_cte(tokens: str = "toks", key: str = "doc_id", start: str = "3") -> str:
    """Word rows of a vocabulary built from a tokens relation."""
    return f"""
    SELECT token, ({start} + row_number() OVER (ORDER BY fst.d, fst.p))::BIGINT AS id, n::BIGINT AS n,
           fst.d::BIGINT AS first_doc, fst.p::BIGINT AS first_pos
    FROM (SELECT token, count(*) AS n, min({{'d': {key}, 'p': pos}}) AS fst FROM {tokens} GROUP BY token)"""


def doc_vocab_with(extra: str = "") -> str:
    """WITH clause defining toks and vocab over documents."""
    return f"""WITH toks AS ({tokens_cte()}),
    vocab AS ({SPECIALS_SQL} UNION ALL {vocab_cte()}){extra}"""


def encode_cte(table: str, key: str, text: str, vocab: str = "vocab", frozen: bool = False) -> str:
    tid = "coalesce(v.id, 1)" if frozen else "v.id"
    return f"""
    SELECT s.{key}, [2::BIGINT] || coalesce(list({tid} ORDER BY t.pos) FILTER (WHERE t.pos IS NOT NULL), [])::BIGINT[] || [3::BIGINT] AS ids
    FROM {table} s
    LEFT JOIN ({tokens_cte(table, key, text)}) t ON t.{key} = s.{key}
    LEFT JOIN {vocab} v ON v.token = t.token
    GROUP BY s.{key}"""


def decode_cte(seqs: str, key: str = "seq_id", vocab: str = "vocab", out: str = "text") -> str:
    return f"""
    SELECT s.{key}, coalesce(a.txt, '') AS {out} FROM {seqs} s LEFT JOIN (
      SELECT {key}, string_agg(piece, '' ORDER BY k) AS txt FROM (
        SELECT {key}, k,
               CASE WHEN row_number() OVER (PARTITION BY {key} ORDER BY k) > 1 AND w NOT IN ('.', ',', '!', '?', ';', ':')
                    THEN ' ' ELSE '' END || w AS piece
        FROM (
          SELECT e.{key}, e.k, coalesce(v.token, '<UNK>') AS w
          FROM (SELECT {key}, unnest(generate_series(1, len(ids))) AS k, unnest(ids) AS token_id FROM {seqs}) e
          LEFT JOIN {vocab} v ON v.id = e.token_id
        ) WHERE w NOT IN ('<BOS>', '<EOS>', '<PAD>')
      ) GROUP BY {key}
    ) a ON a.{key} = s.{key}"""


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_sql(col: str, html: bool) -> str:
    """The cleaning chain of sources.clean as DuckDB expressions."""
    from ..sources import clean as C

    e = col
    if html:
        for pat in C.HTML_DROP_BLOCKS:
            e = f"regexp_replace({e}, {lit(pat)}, '', 'g')"
        e = f"regexp_replace({e}, {lit(C.HTML_BREAKS)}, chr(10), 'g')"
        e = f"regexp_replace({e}, {lit(C.HTML_TAG)}, '', 'g')"
        for ent, ch in C.ENTITIES:
            e = f"replace({e}, {lit(ent)}, {lit(ch)})"
    for pat in C.WIKI_DROP:
        e = f"regexp_replace({e}, {lit(pat)}, '', 'g')"
    for pat, grp in (C.WIKI_LINK_LABEL, C.WIKI_LINK):
        e = f"regexp_replace({e}, {lit(pat)}, '\\{grp}', 'g')"
    return e


def prose_lines_sql(body: str) -> str:
    from ..sources import clean as C

    return (
        f"array_to_string(list_filter(list_transform(string_split({body}, chr(10)), "
        f"lambda l: regexp_replace(l, {lit(C.LINE_TRIM)}, '', 'g')), "
        f"lambda l: l <> '' AND NOT regexp_matches(l, {lit(C.LINE_DROP)})), chr(10))"
    )


def page_drop_sql(body: str) -> str:
    from ..sources import clean as C

    conds = [f"regexp_matches({body}, {lit(C.PAGE_DROP_REDIRECT)})"] + [
        f"contains({body}, {lit(m)})" for m in C.PAGE_DROP_MARKERS
    ]
    return "(" + " OR ".join(conds) + ")"


def clean_pages_sql(table: str = "pages", html: bool = True) -> str:
    return f"""SELECT page_id, text FROM (
      SELECT page_id, {prose_lines_sql('body')} AS text FROM (
        SELECT page_id, {clean_sql('html', html)} AS body FROM {table})
      WHERE NOT {page_drop_sql('body')})
    WHERE text <> ''"""


def enc_docs_with(extra: str) -> str:
    """WITH toks, vocab, enc (documents encoded), seqs (seq_id, ids)."""
    return doc_vocab_with(
        f""", enc AS ({encode_cte('documents', 'doc_id', 'text')}),
        seqs AS (SELECT doc_id AS seq_id, ids FROM enc){extra}"""
    )


def windows_sql(seqs: str, max_len: int) -> str:
    return f"""SELECT seq_id, i::BIGINT AS i, ids[i + 2 - least(i + 1, {max_len}) : i + 1] AS input, ids[i + 2] AS target
        FROM (SELECT seq_id, ids, unnest(range(0, len(ids) - 1)) AS i FROM {seqs})"""


def sample_sql(seqs: str, k: int, max_len: int, seed: int, epoch: int) -> str:
    from ..functions.random import hash_draw_sql

    u = hash_draw_sql(seed, "sample", str(epoch), "r.range")
    return f"""SELECT sample_no, seq_id, (g - off)::BIGINT AS i,
           ids[(g - off) + 2 - least(g - off + 1, {max_len}) : g - off + 1] AS input, ids[g - off + 2] AS target
        FROM (SELECT r.range AS sample_no, floor({u} * t)::BIGINT AS g
              FROM range({k}) r, (SELECT sum(len(ids) - 1)::BIGINT AS t FROM {seqs} WHERE len(ids) >= 2)) d
        JOIN (SELECT seq_id, ids, (len(ids) - 1)::BIGINT AS cnt,
                     (sum(len(ids) - 1) OVER (ORDER BY seq_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - (len(ids) - 1))::BIGINT AS off
              FROM {seqs} WHERE len(ids) >= 2) o
        ON d.g >= o.off AND d.g < o.off + o.cnt"""


E_CTE = """E AS (SELECT i, j, v FROM (
      SELECT vec_id::BIGINT AS i, unnest(generate_series(0, len(embedding) - 1))::BIGINT AS j, unnest(embedding)::DOUBLE AS v
      FROM embeddings) WHERE j < (SELECT len(embedding) FROM embeddings ORDER BY vec_id LIMIT 1)),
    SH AS (SELECT max(i) + 1 AS r, max(j) + 1 AS c FROM E)"""


def q6(x: str) -> str:
    return f"(round(({x}) * 1e6) / 1e6 + 0.0)"


def random_cells_sql(seed: int, name: str) -> str:
    from ..functions.random import hash_uniform_sql

    u = hash_uniform_sql(seed, name, "a.range", "b.range")
    return f"""SELECT a.range::BIGINT AS i, b.range::BIGINT AS j, ({u} * 2.0 - 1.0) AS v
      FROM SH, range(SH.r) a, range(SH.c) b"""


# ------------------------------------------------------------------ model (relational)
def init_params_sql(v_expr: str, d: int, h: int, layers: int, seed: int, max_len: int = 512) -> str:
    """UNION ALL of every parameter's rows, as init_params builds them."""
    from ..functions.random import hash_uniform_sql

    def sym(name, r, j):
        return f"({hash_uniform_sql(seed, name, r, j)} * 2.0 - 1.0)"

    def block(name, rows, cols, kind, lim_rows=None, lim_cols=None):
        r = "r.range"
        if kind == "xavier":
            lim = f"sqrt(6.0 / ({lim_rows or rows} + {lim_cols or cols}))"
            cell = f"{sym(name, r, 'j')} * {lim}"
        elif kind == "random":
            cell = sym(name, r, "j")
        elif kind == "ones":
            cell = "1.0"
        elif kind == "zeros":
            cell = "0.0"
        else:
            angle = f"({r} / pow(10000.0, (j - j % 2) / {float(d)}))"
            cell = f"CASE WHEN j % 2 = 0 THEN sin({angle}) ELSE cos({angle}) END"
        n_rows = "(SELECT vs FROM VV)" if rows == v_expr else rows
        return (
            f"SELECT '{name}' AS param, {r}::BIGINT AS row_id, "
            f"list_transform(range({cols}), lambda j: ({cell})::DOUBLE) AS vec FROM range({n_rows}) r, VV"
        )

    parts = [block("embedding", v_expr, d, "xavier"), block("positional_encoding", max_len, d, "sincos")]
    for layer in range(layers):
        p = f"transformer_{layer}"
        for nm in ("attn_query", "attn_key", "attn_value", "attn_output"):
            parts.append(block(f"{p}_{nm}", d, d, "xavier"))
        parts += [
            block(f"{p}_ff_w1", d, h, "xavier"),
            block(f"{p}_ff_w2", h, d, "xavier"),
            block(f"{p}_ff_b1", 1, h, "random"),
            block(f"{p}_ff_b2", 1, d, "random"),
            block(f"{p}_ln1_gamma", 1, d, "ones"),
            block(f"{p}_ln1_beta", 1, d, "zeros"),
            block(f"{p}_ln2_gamma", 1, d, "ones"),
            block(f"{p}_ln2_beta", 1, d, "zeros"),
        ]
    parts += [
        block("final_ln_gamma", 1, d, "ones"),
        block("final_ln_beta", 1, d, "zeros"),
        block("output_layer", v_expr, d, "xavier", lim_rows=str(d), lim_cols=v_expr),
    ]
    return "\n      UNION ALL ".join(parts)


def q6_list(col: str) -> str:
    return f"list_transform({col}, lambda x: round(x * 1e6) / 1e6 + 0.0)"


def cells_sql(name: str) -> str:
    return f"(SELECT row_id AS k, unnest(generate_series(0, len(vec) - 1)) AS j, unnest(vec) AS w FROM PR WHERE param = '{name}')"


def vec_sql(name: str) -> str:
    return f"(SELECT unnest(generate_series(0, len(vec) - 1)) AS k, unnest(vec) AS w FROM PR WHERE param = '{name}' AND row_id = 0)"


def matmul_sql(x: str, name: str) -> str:
    return f"SELECT seq_id, pos, c.j AS k, sum(x * c.w) AS x FROM {x} JOIN {cells_sql(name)} c USING (k) GROUP BY seq_id, pos, c.j"


def ln_sql(x: str, gamma: str, beta: str, eps: float) -> str:
    return f"""SELECT seq_id, pos, k, (x - avg(x) OVER w) / sqrt(var_pop(x) OVER w + {eps}) * g.w + b.w AS x
        FROM {x} JOIN {vec_sql(gamma)} g USING (k) JOIN {vec_sql(beta)} b USING (k)
        WINDOW w AS (PARTITION BY seq_id, pos)"""


def attention_sql(x: str, layer: int, scale: float) -> str:
    p = f"transformer_{layer}"
    return f"""SELECT seq_id, pos, k, x FROM (
      WITH Q AS ({matmul_sql(x, p + '_attn_query')}),
           K AS ({matmul_sql(x, p + '_attn_key')}),
           V AS ({matmul_sql(x, p + '_attn_value')}),
           S AS (SELECT q.seq_id, q.pos AS i, kk.pos AS t, sum(q.x * kk.x) * {scale!r} AS s
                 FROM Q q JOIN K kk ON q.seq_id = kk.seq_id AND q.k = kk.k AND kk.pos <= q.pos GROUP BY q.seq_id, q.pos, kk.pos),
           E AS (SELECT seq_id, i, t, exp(s - max(s) OVER (PARTITION BY seq_id, i)) AS e FROM S),
           A AS (SELECT seq_id, i, t, e / sum(e) OVER (PARTITION BY seq_id, i) AS a FROM E),
           O AS (SELECT a.seq_id, a.i AS pos, v.k, sum(a.a * v.x) AS x FROM A a JOIN V v ON a.seq_id = v.seq_id AND a.t = v.pos GROUP BY a.seq_id, a.i, v.k)
      {matmul_sql('O', p + '_attn_output')})"""


def ff_sql(x: str, layer: int) -> str:
    p = f"transformer_{layer}"
    gelu = "0.5 * h * (1.0 + tanh(sqrt(2.0 / pi()) * (h + 0.044715 * h * h * h)))"
    return f"""SELECT seq_id, pos, k, x FROM (
      WITH H1 AS (SELECT seq_id, pos, m.k, m.x + b.w AS h FROM ({matmul_sql(x, p + '_ff_w1')}) m JOIN {vec_sql(p + '_ff_b1')} b USING (k)),
           H2 AS (SELECT seq_id, pos, k, {gelu} AS x FROM H1)
      SELECT seq_id, pos, m.k, m.x + b.w AS x FROM ({matmul_sql('H2', p + '_ff_w2')}) m JOIN {vec_sql(p + '_ff_b2')} b USING (k))"""


def layers_sql(d: int, heads: int, max_len: int = 512, eps: float = 1e-6) -> str:
    """CTEs after PR and TK(seq_id, pos, token_id): X0 and X1 (embeddings, with
    positions), N1, ATT, XA, N2, FF, XB (one block, inference) and XF (final
    norm), each computed once."""
    scale = 1.0 / (d // heads) ** 0.5
    return f"""X0 AS MATERIALIZED (SELECT seq_id, pos, unnest(generate_series(0, {d - 1}))::BIGINT AS k,
                  unnest(coalesce(e.vec, list_transform(range({d}), lambda z: 0.0))) AS x
           FROM TK LEFT JOIN (SELECT row_id AS token_id, vec FROM PR WHERE param = 'embedding') e USING (token_id)),
    PE AS (SELECT p.range::BIGINT AS pos, c.range::BIGINT AS k,
                  CASE WHEN c.range % 2 = 0 THEN sin(p.range / pow(10000.0, (c.range - c.range % 2) / {float(d)}))
                       ELSE cos(p.range / pow(10000.0, (c.range - c.range % 2) / {float(d)})) END AS pe
           FROM range({max_len}) p, range({d}) c),
    X1 AS MATERIALIZED (SELECT seq_id, pos, k, x + coalesce(pe, 0.0) AS x FROM X0 LEFT JOIN PE USING (pos, k)),
    N1 AS MATERIALIZED ({ln_sql('X1', 'transformer_0_ln1_gamma', 'transformer_0_ln1_beta', eps)}),
    ATT AS MATERIALIZED ({attention_sql('N1', 0, scale)}),
    XA AS MATERIALIZED (SELECT seq_id, pos, k, a.x + b.x AS x FROM ATT a JOIN X1 b USING (seq_id, pos, k)),
    N2 AS MATERIALIZED ({ln_sql('XA', 'transformer_0_ln2_gamma', 'transformer_0_ln2_beta', eps)}),
    FF AS MATERIALIZED ({ff_sql('N2', 0)}),
    XB AS MATERIALIZED (SELECT seq_id, pos, k, a.x + b.x AS x FROM FF a JOIN XA b USING (seq_id, pos, k)),
    XF AS MATERIALIZED ({ln_sql('XB', 'final_ln_gamma', 'final_ln_beta', eps)})"""


def states_sql(d: int, every: bool = False) -> str:
    """CTEs after XF: H, the state of each sequence's last position (or of every
    position), and W, the output rows."""
    last = "" if every else "WHERE pos = (SELECT max(pos) FROM TK t WHERE t.seq_id = XF.seq_id)"
    return f"""H AS MATERIALIZED (SELECT seq_id, pos, list(x ORDER BY k)::DOUBLE[{d}] AS h FROM XF {last} GROUP BY seq_id, pos),
    W AS MATERIALIZED (SELECT row_id AS token_id, vec::DOUBLE[{d}] AS w FROM PR WHERE param = 'output_layer')"""


def q9(x: str) -> str:
    return f"(round(({x}) * 1e9) / 1e9 + 0.0)"
