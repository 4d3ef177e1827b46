"""DuckDB SQL fragments mirroring caselake's column functions, for oracle queries.

DuckDB string literals do not interpret backslash escapes, so newlines are
written as chr(10); regex patterns keep RE2 escapes such as ``\\s``.
"""

from __future__ import annotations

from caselake.operators.term_index import TOKEN_PATTERN

NL = "chr(10)"
NL2 = "(chr(10) || chr(10))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def strip_html(x: str) -> str:
    inner = f"regexp_replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')"
    return f"coalesce({strip(inner)}, '')"


def effective_text(plain: str, html: str, rule: str = "chunk", min_len: int = 150) -> str:
    p = f"coalesce({strip(plain)}, '')"
    if rule == "lake":
        return f"(CASE WHEN length({p}) >= {min_len} THEN {p} ELSE {strip_html(html)} END)"
    return f"(CASE WHEN {p} <> '' THEN {p} ELSE {strip_html(html)} END)"


def year_of(x: str) -> str:
    return f"(CASE WHEN length({x}) >= 4 THEN coalesce(TRY_CAST(substr({x}, 1, 4) AS INTEGER), 0) ELSE 0 END)"


def nullif_blank(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def blank(x: str) -> str:
    return f"coalesce({strip(x)} = '', true)"


def normalize_newlines(x: str) -> str:
    t = f"regexp_replace({x}, '\\r\\n', {NL}, 'g')"
    t = f"regexp_replace({t}, '\\n{{3,}}', {NL2}, 'g')"
    return strip(t)


def int_or_zero(x: str, default: int = 0) -> str:
    return (f"coalesce(CASE WHEN regexp_full_match(trim(CAST({x} AS VARCHAR)), '[0-9]+') "
            f"THEN TRY_CAST(trim(CAST({x} AS VARCHAR)) AS BIGINT) END, {default})")


def court_label(x: str) -> str:
    return (f"(CASE {x} WHEN 'sc' THEN 'SC Supreme Court' WHEN 'scctapp' THEN 'SC Court of Appeals' "
            f"WHEN 'scotus' THEN 'US Supreme Court' WHEN 'ca4' THEN '4th Circuit Court of Appeals' ELSE {x} END)")


def format_bytes(n: str) -> str:
    return (f"(CASE WHEN {n} < 1000000 THEN CAST({n} // 1000 AS VARCHAR) || ' KB' "
            f"WHEN {n} < 1000000000 THEN printf('%.1f', {n} / 1e6) || ' MB' "
            f"ELSE printf('%.2f', {n} / 1e9) || ' GB' END)")


def units(text: str, size: int = 3000) -> str:
    """list<struct(u, sep)> of a normalized text (paragraphs; sentences of long ones)."""
    paras = (f"list_filter(list_transform(string_split_regex({normalize_newlines(text)}, '\\n\\n+'), "
             f"lambda x: {strip('x')}), lambda x: x <> '')")
    sentences = ("list_transform(string_split(regexp_replace(x, '([.!?])\\s+([A-Z])', "
                 "'\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda s: {'u': s, 'sep': ' '})")
    return (f"flatten(list_transform({paras}, lambda x: CASE WHEN length(x) > {size} "
            f"THEN {sentences} ELSE [{{'u': x, 'sep': {NL2}}}] END))")


def chunk_state(unit_list: str, size: int = 3000, overlap: int = 500) -> str:
    """struct(chunks, buf): the greedy pack-with-overlap fold over units."""
    emit = f"CASE WHEN {strip('acc.buf')} <> '' THEN list_append(acc.chunks, {strip('acc.buf')}) ELSE acc.chunks END"
    carry = f"CASE WHEN length(acc.buf) > {overlap} THEN right(acc.buf, {overlap}) ELSE acc.buf END"
    step = (f"lambda acc, x: CASE WHEN length(acc.buf) + length(x.u) + length(x.sep) <= {size} "
            f"THEN {{'chunks': acc.chunks, 'buf': acc.buf || x.u || x.sep}} "
            f"ELSE {{'chunks': {emit}, 'buf': {carry} || x.u || x.sep}} END")
    init = "{'chunks': []::VARCHAR[], 'buf': ''}"
    return f"list_reduce({unit_list}, {step}, {init})"


def chunk_finish(st: str) -> str:
    """Chunks of a fold state: emit the remaining buffer when non-blank."""
    return f"(CASE WHEN {strip(st + '.buf')} <> '' THEN list_append({st}.chunks, {strip(st + '.buf')}) ELSE {st}.chunks END)"


def chunks_cte(source: str, id_cols: str, text: str, size: int = 3000, overlap: int = 500) -> str:
    """SELECT id_cols, chunk_index, chunk FROM <source>, one row per chunk."""
    return f"""
        SELECT {id_cols}, chunk_index, chunk FROM (
            SELECT {id_cols}, CAST(unnest(generate_series(0, len(ch) - 1)) AS INTEGER) AS chunk_index, unnest(ch) AS chunk
            FROM (SELECT {id_cols}, {chunk_finish('st')} AS ch
                  FROM (SELECT {id_cols}, {chunk_state(units(text, size), size, overlap)} AS st FROM {source})))"""


TOKEN_SQL = TOKEN_PATTERN.replace("'", "''")


def hash_vectors(name: str, source: str, id_col: str, text_col: str, dim: int) -> str:
    """CTEs ending in `<name>(id, b, v)`: nonzero hashing-encoder components as FLOAT."""
    return f"""
    {name}_tok AS (SELECT {id_col} AS id, unnest(regexp_extract_all(lower(coalesce({text_col}, '')), '{TOKEN_SQL}')) AS tok
                   FROM {source}),
    {name}_b AS (SELECT id, ('0x' || substr(md5(tok), 1, 8))::BIGINT % {dim} AS b,
                        CASE WHEN ('0x' || substr(md5(tok), 9, 2))::INTEGER % 2 = 0 THEN 1 ELSE -1 END AS s
                 FROM {name}_tok),
    {name}_c AS (SELECT id, b, sum(s) AS c FROM {name}_b GROUP BY id, b),
    {name}_n AS (SELECT id, sqrt(sum(c * c)) AS n FROM {name}_c GROUP BY id),
    {name} AS (SELECT x.id, x.b, CAST(CAST(x.c AS DOUBLE) / nn.n AS FLOAT) AS v
               FROM {name}_c x JOIN {name}_n nn ON x.id = nn.id WHERE nn.n > 0)"""


def bm25_scores(name: str, queries: str, q_id: str, q_text: str, docs: str, d_id: str, d_text: str) -> str:
    """CTEs ending in `<name>(query_id, item_id, score)`: BM25 (k1 1.2, b 0.75), rounded to 6."""
    def toks(text):
        return f"regexp_extract_all(lower(coalesce({text}, '')), '{TOKEN_SQL}')"

    return f"""
    {name}_qt AS (SELECT DISTINCT {q_id} AS query_id, unnest({toks(q_text)}) AS term FROM {queries}),
    {name}_dl AS (SELECT {d_id} AS item_id, {toks(d_text)} AS toks FROM {docs}),
    {name}_st AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM {name}_dl),
    {name}_tf AS (SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest(toks) AS term FROM {name}_dl)
                  WHERE term IN (SELECT term FROM {name}_qt) GROUP BY ALL),
    {name}_df AS (SELECT term, count(*) AS df FROM {name}_tf GROUP BY term),
    {name} AS (SELECT q.query_id, tf.item_id,
                      round(sum(ln(1 + (st.n - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2
                                / (tf.tf + 1.2 * (1 - 0.75 + 0.75 * len(dl.toks) / st.avgdl))), 6) AS score
               FROM {name}_qt q JOIN {name}_tf tf ON q.term = tf.term JOIN {name}_df df ON q.term = df.term
                    JOIN {name}_dl dl ON tf.item_id = dl.item_id CROSS JOIN {name}_st st
               GROUP BY q.query_id, tf.item_id)"""


def topk(source: str, k: int, ascending: bool = False, extra: str = "") -> str:
    order = "score ASC" if ascending else "score DESC"
    return f"""SELECT query_id, item_id, score, rank{extra} FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY {order}, item_id) AS INTEGER) AS rank
        FROM {source}) WHERE rank <= {k}"""
