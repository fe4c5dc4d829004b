"""DuckDB SQL fragments for the oracle queries, spelled from the same fixed
values the Spark side uses."""

from __future__ import annotations

from collections.abc import Iterable

from tidemark.functions.fixed import (
    ENGLISH_STOP_WORDS,
    KEY_PHRASES,
    NOUN_EXCEPTIONS,
    NOUN_SUFFIX_RULES,
)

_WS = r"\t\n\x{0B}\f\r \p{Z}\x{1C}-\x{1F}\x{85}"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(items: Iterable[str]) -> str:
    return "[" + ", ".join(lit(x) for x in items) + "]"


def clean(col: str) -> str:
    return (f"regexp_replace(regexp_replace(lower(coalesce({col}, '')), "
            f"'[^\\p{{L}}\\p{{N}}_{_WS}]', '', 'g'), '\\p{{Nd}}+', '', 'g')")


def tokens(clean_expr: str) -> str:
    return f"list_filter(regexp_split_to_array({clean_expr}, '[{_WS}]+'), lambda x: x <> '')"


def drop_stop(list_expr: str, stop: Iterable[str] = ENGLISH_STOP_WORDS) -> str:
    return f"list_filter({list_expr}, lambda x: NOT list_contains({str_list(sorted(set(stop)))}, x))"


def phrase_hits(text_expr: str, phrases: Iterable[str] = KEY_PHRASES) -> str:
    parts = [f"CASE WHEN contains({text_expr}, {lit(p)}) THEN 1 ELSE 0 END" for p in phrases]
    return "CAST((" + " + ".join(parts) + ") AS INTEGER)"


def compound(sum_expr: str, alpha: float = 15.0, decimals: int = 4) -> str:
    s = f"coalesce(CAST({sum_expr} AS DOUBLE), 0.0)"
    return f"abs(round({s} / sqrt({s} * {s} + {alpha}), {decimals}))"


# Posts of the documents adapter (source / doc_id div 100, label 1 - quality).
DOC_POSTS = f"""
posts AS (
  SELECT d.source AS match_id, d.doc_id // 100 AS period_id,
         d.source || ':' || CAST(d.doc_id // 100 AS VARCHAR) AS id,
         d.doc_id AS post_id, d.lang, d.text,
         1.0 - CAST(l.quality AS DOUBLE) AS event_type,
         {drop_stop(tokens(clean('d.text')))} AS tokens
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

# English-document token counts (the dictionary).
EN_COUNTS = f"""
en_counts AS (
  SELECT token AS term, count(*) AS cnt
  FROM (SELECT unnest({tokens(clean('text'))}) AS token FROM documents WHERE lang = 'en')
  GROUP BY token)"""

# Word vectors: stop-filtered English tokens ranked by (count desc, token asc).
WORD_VECTORS = f"""
vec_rank AS (
  SELECT token AS word, row_number() OVER (ORDER BY count(*) DESC, token ASC) - 1 AS vec_id
  FROM (SELECT unnest({drop_stop(tokens(clean('text')))}) AS token FROM documents WHERE lang = 'en')
  GROUP BY token),
word_vectors AS (
  SELECT r.word, CAST(e.embedding AS DOUBLE[]) AS vec
  FROM vec_rank r JOIN embeddings e ON r.vec_id = e.vec_id)"""

LEXICON = f"""
lexicon AS (
  SELECT token, ((length(token) % 9) - 4) / 2.0 AS valence
  FROM (SELECT DISTINCT unnest({tokens(clean('text'))}) AS token FROM benchmark))"""

EMB_DIM = "(SELECT max(len(embedding)) FROM embeddings)"


def zeros(dim_expr: str = EMB_DIM) -> str:
    return f"list_transform(range({dim_expr}), lambda x: 0.0)"


def round_list(list_expr: str, decimals: int = 4) -> str:
    return f"list_transform({list_expr}, lambda x: round(x, {decimals}) + 0.0)"


# Per-post mean word vector as (post_id, i, x) rows, from a (post_id, token) table.
def post_vec_rows(toks: str) -> str:
    return f"""
  SELECT post_id, i, avg(x) AS x FROM (
    SELECT t.post_id, unnest(range(len(w.vec))) AS i, unnest(w.vec) AS x
    FROM {toks} t JOIN word_vectors w ON t.token = w.word)
  GROUP BY ALL"""


# Row-level volume change over posts (post_id order inside a period).
ROW_LAG = """
sized AS (SELECT *, count(*) OVER (PARTITION BY match_id, period_id, id) AS tn FROM posts),
lagged AS (SELECT *, lag(tn, 2) OVER (PARTITION BY match_id ORDER BY period_id, id, post_id) AS tn2
           FROM sized),
rowlag AS (
  SELECT match_id, period_id, id,
         avg(CASE WHEN tn2 IS NULL THEN 0 ELSE tn - tn2 END) AS vc,
         max(abs(CASE WHEN tn2 IS NULL THEN 0 ELSE tn - tn2 END)) AS absmax
  FROM lagged GROUP BY ALL)"""


# Every distinct stop-filtered token of all documents.
TOKS = f"""
toks AS (SELECT DISTINCT unnest({drop_stop(tokens(clean('text')))}) AS token FROM documents)"""


def _swap(a: str, b: str, i: str = "i") -> str:
    """``b`` is ``a`` with one pair of neighbours swapped."""
    return (f"(length({a}) = length({b}) AND length({a}) >= 2 AND coalesce(list_bool_or(list_transform("
            f"range(1, length({a})), lambda {i}: left({a}, {i} - 1) || substr({a}, {i} + 1, 1) || "
            f"substr({a}, {i}, 1) || substr({a}, {i} + 2) = {b})), false))")


def _one(a: str, b: str) -> str:
    return f"(levenshtein({a}, {b}) <= 1 OR {_swap(a, b, 'k')})"


def _swap_and_one_more() -> str:
    cases = []
    for d in (-1, 0, 1):
        j = f"(i + {d})"
        ah, bh = "left(a, i - 1)", f"left(b, {j} - 1)"
        at, bt = "substr(a, i + 2)", f"substr(b, {j} + 2)"
        cases.append(f"({j} >= 1 AND {j} + 1 <= length(b) AND substr(a, i, 1) = substr(b, {j} + 1, 1) "
                     f"AND substr(a, i + 1, 1) = substr(b, {j}, 1) "
                     f"AND (({ah} = {bh} AND {_one(at, bt)}) OR ({at} = {bt} AND {_one(ah, bh)})))")
    return (f"coalesce(list_bool_or(list_transform(range(1, length(a)), lambda i: {' OR '.join(cases)})), "
            "false)")


def _deleted(word: str) -> str:
    """Hashes of the whole word and of what is left of it after one or two deletions."""
    def one(w: str, i: str) -> str:
        return f"list_transform(range(1, length({w}) + 1), lambda {i}: left({w}, {i} - 1) || substr({w}, {i} + 1))"
    twice = f"flatten(list_transform({one(word, 'i')}, lambda y: {one('y', 'j')}))"
    return (f"unnest(list_distinct(list_transform(list_concat([{word}], {one(word, 'i')}, {twice}), "
            "lambda z: hash(z))))")


# Spelling: words within two edits share what is left after at most two
# deletions from each, whole words here. (``scripts/spelling_bruteforce.py``
# compares all pairs.) The distances count bytes, so other letters are first
# mapped to characters that cannot occur after cleaning.
# ``spelled (token, corrected, distance)``.
_SLOTS = "[" + ", ".join(map(str, [*range(65, 91), *range(33, 65), 91, 92, 93, 94, 96, 123, 124, 125, 126])) + "]"
SPELLED = f"""
chars AS (SELECT DISTINCT ch FROM (SELECT unnest(string_split(w, '')) AS ch
          FROM (SELECT token AS w FROM toks UNION SELECT term FROM en_counts)) WHERE ord(ch) > 127),
slots AS (SELECT ch, row_number() OVER (ORDER BY ch) AS k FROM chars),
cmap AS (SELECT coalesce(string_agg(ch, '' ORDER BY k), '') AS src,
                coalesce(string_agg(chr({_SLOTS}[k]), '' ORDER BY k), '') AS dst FROM slots),
unknown AS (SELECT token, translate(token, src, dst) AS a FROM toks, cmap
            WHERE token NOT IN (SELECT term FROM en_counts)),
known AS (SELECT term, cnt, translate(term, src, dst) AS b FROM en_counts, cmap),
near_pairs AS (SELECT DISTINCT token, term, cnt, a, b
               FROM (SELECT token, a, {_deleted('a')} AS h FROM unknown)
               JOIN (SELECT term, cnt, b, {_deleted('b')} AS h FROM known) USING (h)),
close AS (SELECT *, levenshtein(a, b) AS lev FROM near_pairs WHERE damerau_levenshtein(a, b) <= 2),
osa AS (SELECT token, term, cnt, CASE WHEN lev <= 1 THEN lev WHEN lev = 2 THEN
          CASE WHEN {_swap('a', 'b')} THEN 1 ELSE 2 END
          WHEN {_swap_and_one_more()} THEN 2 END AS dist FROM close),
nearest AS (SELECT token, arg_min({{'term': term, 'dist': dist}}, (dist, -cnt, term)) AS x
            FROM osa WHERE dist IS NOT NULL GROUP BY token),
spelled AS (SELECT t.token, coalesce(n.x.term, t.token) AS corrected,
                   CASE WHEN e.term IS NOT NULL THEN 0 ELSE n.x.dist END AS distance
            FROM toks t LEFT JOIN en_counts e ON t.token = e.term LEFT JOIN nearest n ON t.token = n.token)"""


def lemmas(source: str, col: str = "token") -> str:
    """CTEs giving ``lemma_of (token, lemma)`` for the distinct ``col`` of ``source`` against the
    dictionary terms; the rules are applied until no form is left. Needs WITH RECURSIVE."""
    rules = ", ".join(f"({i + 1}, {lit(o)}, {lit(n)})" for i, (o, n) in enumerate(NOUN_SUFFIX_RULES))
    exc = ", ".join(f"({lit(a)}, {lit(b)})" for a, b in NOUN_EXCEPTIONS)
    return f"""
rules AS (SELECT * FROM (VALUES {rules}) t(ri, old, new)),
exc AS (SELECT * FROM (VALUES {exc}) t(token, lemma)),
asked AS (SELECT DISTINCT {col} AS token FROM {source}),
forms AS (
  SELECT token, 0 AS depth, CAST([] AS INTEGER[]) AS ord, token AS form FROM asked
  WHERE token NOT IN (SELECT token FROM exc)
  UNION ALL
  SELECT f.token, f.depth + 1, list_append(f.ord, r.ri),
         left(f.form, length(f.form) - length(r.old)) || r.new
  FROM forms f JOIN rules r ON suffix(f.form, r.old)),
cands AS (
  SELECT token, greatest(depth - 1, 0) AS lvl, depth, ord, form FROM forms
  UNION ALL SELECT token, -1, 0, [], token FROM asked WHERE token IN (SELECT token FROM exc)
  UNION ALL SELECT a.token, -1, 1, [], e.lemma FROM asked a JOIN exc e ON a.token = e.token),
best AS (
  SELECT token, form FROM (
    SELECT c.*, row_number() OVER (PARTITION BY c.token ORDER BY lvl, length(c.form), depth, ord) AS rn
    FROM cands c JOIN en_counts v ON c.form = v.term) WHERE rn = 1),
lemma_of AS (SELECT a.token, coalesce(b.form, a.token) AS lemma FROM asked a LEFT JOIN best b ON a.token = b.token)"""


# Full cleaning: ``token_map (token, out)`` of spelling, then lemma.
TOKEN_MAP = f"""
{EN_COUNTS}, {TOKS}, {SPELLED}, {lemmas('spelled', 'corrected')},
token_map AS (SELECT s.token, l.lemma AS out FROM spelled s JOIN lemma_of l ON s.corrected = l.token)"""


def mapped(source: str, key: str, col: str = "tokens") -> str:
    """``(key, tokens)`` of ``source`` with every token replaced."""
    return f"""
  SELECT {key}, list(out ORDER BY pos) AS {col} FROM (
    SELECT {key}, pos, m.out FROM (
      SELECT {key}, unnest({col}) AS token, unnest(range(len({col}))) AS pos FROM {source}) x
    JOIN token_map m ON x.token = m.token)
  GROUP BY {key}"""


# Posts of the documents adapter, fully cleaned (needs TOKEN_MAP).
FULL_POSTS = f"""
{DOC_POSTS.replace("posts AS", "raw_posts AS", 1)},
mapped_posts AS ({mapped('raw_posts', 'post_id')}),
posts AS (SELECT r.* EXCLUDE (tokens), coalesce(m.tokens, []) AS tokens
          FROM raw_posts r LEFT JOIN mapped_posts m USING (post_id))"""
