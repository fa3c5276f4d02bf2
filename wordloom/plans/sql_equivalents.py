"""The named queries once more, in DuckDB SQL over the view `documents`.

They are written from the definitions, line by line and token by token, and share
no logic with the DataFrame code; the tables of the stemmer are stated here once more, from
the published rules, so that a wrong one there does not agree with itself. Sizes and the stop
list are those of the queries.
"""

from __future__ import annotations

from wordloom.plans.catalogue import ASSUMED_DOCUMENTS, DISTANCES, LEAST_COUNT, TILE, TOP_TERMS, TOP_WORDS, WIDE, stop_patterns


# The rules of steps 2, 3 and 4 in the order of the paper, with its two amendments.
RULES_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"), ("alli", "al"),
    ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"),
    ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
)
RULES_3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
RULES_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _lines(name: str, fold: bool = True, strip: bool = False) -> str:
    """CTE `name`(doc_id, line_no, n_lines, line)."""
    line = "lower(line)" if fold else "line"
    if strip:
        listed = ", ".join(map(_quote, stop_patterns()))
        line = f"list_reduce(list_prepend({line}, [{listed}]), lambda a, p: replace(a, p, ''))"
    return f"""
{name}_parts AS (SELECT doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') AS parts FROM documents),
{name}_raw AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS line_no,
         len(parts) - (parts[-1] = '')::INT AS n_lines
  FROM {name}_parts),
{name} AS (SELECT doc_id, line_no::INTEGER AS line_no, n_lines, {line} AS line FROM {name}_raw WHERE line_no < n_lines)"""


def _tokens(name: str, **how) -> str:
    """CTE `name`(doc_id, line_no, n_lines, pos, token)."""
    return f"""{_lines(f"{name}_lines", **how)},
{name}_cut AS (SELECT *, regexp_replace(line, '[^\\w'']+$', '') AS cut FROM {name}_lines),
{name}_lists AS (
  SELECT doc_id, line_no, n_lines, CASE WHEN line = '' THEN [''] WHEN cut = '' THEN []
         ELSE string_split_regex(cut, '[^\\w'']+') END AS list FROM {name}_cut),
{name} AS (SELECT doc_id, line_no, n_lines, unnest(range(len(list)))::INTEGER AS pos, unnest(list) AS token
  FROM {name}_lists)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(cte.strip() for cte in ctes)


def _counts(name: str, tokens: str) -> str:
    return f"{name} AS (SELECT token AS word, count(*) AS n FROM {tokens} GROUP BY token)"


def _top(name: str, counts: str) -> str:
    return f"{name} AS (SELECT word, n FROM {counts} ORDER BY n DESC, word LIMIT {TOP_WORDS})"


def _vocabulary(name: str = "vocab", tokens: str = "tok") -> str:
    return _counts(f"{name}_counts", tokens) + ",\n" + _top(name, f"{name}_counts")


def _events(d: int) -> str:
    return f"""ev AS (
  SELECT x.doc_id, x.line_no, x.pos AS pos1, y.pos AS pos2, x.token AS w1, y.token AS w2
  FROM tok x JOIN tok y ON x.doc_id = y.doc_id AND x.line_no = y.line_no AND y.pos - x.pos BETWEEN 1 AND {d}
  WHERE x.token IN (SELECT word FROM vocab) AND y.token IN (SELECT word FROM vocab))"""


PAIRS = "SELECT least(w1, w2) AS w1, greatest(w1, w2) AS w2, count(*) AS n FROM ev GROUP BY ALL"
DIRECTED = "SELECT w1, w2, count(*) AS n FROM ev GROUP BY ALL"


def _stripes(d: int, *vocabulary: str) -> str:
    return f"""{_with(_tokens("tok"), *vocabulary, _events(d), f"dir AS ({DIRECTED})")}
SELECT f.w1 AS word, '[' || string_agg(coalesce(dir.n, 0)::VARCHAR, ', ' ORDER BY v.word) || ']' AS stripe
FROM (SELECT DISTINCT w1 FROM dir) f CROSS JOIN vocab v LEFT JOIN dir ON dir.w1 = f.w1 AND dir.w2 = v.word
GROUP BY f.w1"""


def _shape(word: str) -> str:
    """One letter per character of `word`: v for a vowel, c otherwise; y is v after a c."""
    return (
        f"list_reduce(list_prepend('', string_split({word}, '')), lambda a, c: a || CASE WHEN c IN "
        f"('a', 'e', 'i', 'o', 'u') OR (c = 'y' AND right(a, 1) = 'c') THEN 'v' ELSE 'c' END)"
    )


def _m(length: str) -> str:
    part = f"substr(shape, 1, {length})"
    return f"((length({part}) - length(replace({part}, 'vc', ''))) // 2)"


def _longest(suffixes) -> str:
    ordered = sorted(suffixes, key=len, reverse=True)
    return "CASE " + " ".join(f"WHEN ends_with(w, '{s}') THEN '{s}'" for s in ordered) + " ELSE '' END"


def _mapped(rules: dict[str, str]) -> str:
    return "CASE suffix " + " ".join(f"WHEN '{s}' THEN '{r}'" for s, r in rules.items()) + " END"


def _stems(name: str, tokens: str) -> str:
    """CTE `name`(token, stem) for the distinct tokens, rule by rule."""
    steps: list[tuple[str, str]] = []  # (columns for the step, new value of w)
    short = "right(shape, 3) = 'cvc' AND right(w, 1) NOT IN ('w', 'x', 'y')"
    steps.append((
        "'' AS suffix",
        "CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN left(w, length(w) - 2) "
        "WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN left(w, length(w) - 1) ELSE w END",
    ))
    # A repair is due only after -ed or -ing went; a slash at the end marks those words.
    steps.append((
        "CASE WHEN ends_with(w, 'eed') THEN 'eed' WHEN ends_with(w, 'ed') THEN 'ed' "
        "WHEN ends_with(w, 'ing') THEN 'ing' ELSE '' END AS suffix",
        f"CASE WHEN suffix = 'eed' THEN CASE WHEN {_m('length(w) - 3')} > 0 THEN left(w, length(w) - 1) ELSE w END "
        "WHEN suffix <> '' AND contains(substr(shape, 1, length(w) - length(suffix)), 'v') "
        "THEN left(w, length(w) - length(suffix)) || '/' ELSE w END",
    ))
    steps.append(("ends_with(w, '/') AS suffix", "CASE WHEN suffix THEN left(w, length(w) - 1) ELSE w END"))
    steps.append((
        "repair AS suffix",
        "CASE WHEN NOT repair THEN w WHEN right(w, 2) IN ('at', 'bl', 'iz') THEN w || 'e' "
        "WHEN length(w) > 1 AND right(w, 1) = substr(w, length(w) - 1, 1) AND right(shape, 1) = 'c' "
        "THEN CASE WHEN right(w, 1) IN ('l', 's', 'z') THEN w ELSE left(w, length(w) - 1) END "
        f"WHEN {_m('length(w)')} = 1 AND {short} THEN w || 'e' ELSE w END",
    ))
    steps.append((
        "'' AS suffix",
        "CASE WHEN ends_with(w, 'y') AND contains(substr(shape, 1, length(w) - 1), 'v') "
        "THEN left(w, length(w) - 1) || 'i' ELSE w END",
    ))
    for rules in (dict(RULES_2), dict(RULES_3)):
        steps.append((
            f"{_longest(rules)} AS suffix",
            f"CASE WHEN suffix <> '' AND {_m('length(w) - length(suffix)')} > 0 "
            f"THEN left(w, length(w) - length(suffix)) || {_mapped(rules)} ELSE w END",
        ))
    steps.append((
        f"{_longest(RULES_4)} AS suffix",
        f"CASE WHEN suffix <> '' AND {_m('length(w) - length(suffix)')} > 1 "
        "AND (suffix <> 'ion' OR substr(w, length(w) - 3, 1) IN ('s', 't')) "
        "THEN left(w, length(w) - length(suffix)) ELSE w END",
    ))
    before_e = "right(substr(shape, 1, length(w) - 1), 3) = 'cvc' AND substr(w, length(w) - 1, 1) NOT IN ('w', 'x', 'y')"
    m_e = _m("length(w) - 1")
    steps.append((
        "'' AS suffix",
        f"CASE WHEN ends_with(w, 'e') AND ({m_e} > 1 OR ({m_e} = 1 AND NOT ({before_e}))) "
        "THEN left(w, length(w) - 1) ELSE w END",
    ))
    steps.append((
        "'' AS suffix",
        f"CASE WHEN ends_with(w, 'll') AND {_m('length(w)')} > 1 THEN left(w, length(w) - 1) ELSE w END",
    ))
    ctes = [f"{name}_0 AS (SELECT DISTINCT token, token AS w, false AS repair FROM {tokens} WHERE length(token) > 2)"]
    for i, (suffix, value) in enumerate(steps):
        repair = "suffix" if i == 2 else "repair"
        ctes.append(
            f"{name}_{i + 1} AS (SELECT token, {value} AS w, {repair} AS repair FROM "
            f"(SELECT *, {suffix}, {_shape('w')} AS shape FROM {name}_{i}))"
        )
    ctes.append(
        f"{name} AS (SELECT token, w AS stem FROM {name}_{len(steps)} "
        f"UNION ALL SELECT DISTINCT token, token FROM {tokens} WHERE length(token) <= 2)"
    )
    return ",\n".join(ctes)


def _doc_freq(name: str, tokens: str) -> str:
    return f"{name} AS (SELECT token AS term, count(DISTINCT doc_id) AS df FROM {tokens} GROUP BY token)"


def _ranked(name: str, frequencies: str) -> str:
    return f"""{name} AS (SELECT term, df, (row_number() OVER (ORDER BY df DESC, term) - 1)::INTEGER AS idx
  FROM {frequencies} ORDER BY df DESC, term LIMIT {TOP_TERMS})"""


def _stemmed(name: str, tokens: str) -> str:
    """CTE `name`: the rows of `tokens` with stems for tokens."""
    return f"""{_stems(f"{name}_stems", tokens)},
{name} AS (SELECT doc_id, line_no, n_lines, pos, stem AS token FROM {tokens} JOIN {name}_stems USING (token))"""


def _tf(tokens: str, value: str = "count(*)") -> str:
    return f"SELECT doc_id, term, {value}::BIGINT AS tf FROM {tokens} JOIN ranked ON token = term GROUP BY doc_id, term"


def _tf_idf(tokens: str, n_docs: str, value: str = "count(*)") -> str:
    return f"""found AS ({_tf(tokens, value)}),
with_lines AS (SELECT DISTINCT doc_id FROM tok_lines)
SELECT d.doc_id, r.term, coalesce(f.tf, 0) AS tf,
       round(coalesce(f.tf, 0) * ln({n_docs}::DOUBLE / (1 + r.df)), 6) AS tfidf
FROM with_lines d CROSS JOIN ranked r LEFT JOIN found f ON f.doc_id = d.doc_id AND f.term = r.term"""


PARSED = """escaped AS (SELECT *, replace(line, chr(9), '\\t') AS word FROM l),
tsv AS (SELECT doc_id, line_no, CASE WHEN line_no % 5 = 4 THEN word WHEN line_no % 7 = 3 THEN word || chr(9) || 'x'
    ELSE word || chr(9) || length(line) END AS value FROM escaped),
good AS (SELECT *, split_part(value, chr(9), 1) AS word, try_cast(split_part(value, chr(9), 2) AS BIGINT) AS n FROM
    (SELECT *, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS idx FROM tsv) WHERE contains(value, chr(9)))"""

N_DOCS = "(SELECT count(*) FROM documents)"
RUNNING = "sum(n_lines - line_no)"


def all_sql() -> dict[str, str]:
    tok = _tokens("tok")
    stripped = _tokens("stripped", strip=True)
    vocab = _vocabulary()
    df = _with(tok, _doc_freq("freqs", "tok"))
    ranked = f"{df},\n{_ranked('ranked', 'freqs')}"
    df_stemmed = _with(tok, _stemmed("stm", "tok"), _doc_freq("freqs", "stm"))
    ranked_stemmed = f"{df_stemmed},\n{_ranked('ranked', 'freqs')}"
    df_stripped_stemmed = _with(stripped, _stemmed("stp", "stripped"), _doc_freq("freqs", "stp"))
    ref_vocab = [stripped, _vocabulary(tokens="stripped")]
    in_word_order = "ORDER BY df DESC, term"
    sql = {
        "line_records": f"{_with(_lines('l'))} SELECT doc_id, line_no, line FROM l",
        "lines_stripped": f"{_with(_lines('l', strip=True))} SELECT doc_id, line_no, line FROM l",
        "tokens": f"{_with(tok)} SELECT doc_id, line_no, pos, token FROM tok",
        "word_count": f"{_with(tok, _counts('c', 'tok'))} SELECT word, n FROM c",
        "word_count_case_sensitive": f"{_with(_tokens('t', fold=False), _counts('c', 't'))} SELECT word, n FROM c",
        "word_count_stripped": f"{_with(stripped, _counts('c', 'stripped'))} SELECT word, n FROM c",
        "word_count_sorted_tsv": f"{_with(tok, _counts('c', 'tok'))} SELECT word || chr(9) || n AS line FROM c ORDER BY word",
        "top50_words": f"{_with(tok, vocab)} SELECT word, n FROM vocab",
        "top50_words_stripped": f"{_with(*ref_vocab)} SELECT word, n FROM vocab",
        "vocab_index": f"{_with(tok, vocab)} SELECT word, (row_number() OVER (ORDER BY word) - 1)::INTEGER AS idx FROM vocab",
        "vocab_positions": f"""{_with(tok, vocab)} SELECT doc_id, line_no, pos, token AS word FROM tok
            WHERE token IN (SELECT word FROM vocab)""",
        "cooc_events": f"{_with(tok, vocab, _events(2))} SELECT * FROM ev",
        "cooc_pairs_key": f"""{_with(tok, vocab, _events(1), f"p AS ({PAIRS})")}
            SELECT w1 || ',' || w2 AS pair, n FROM p""",
        "cooc_pairs_per_line": f"""{_with(tok, vocab, _events(2))}
            SELECT doc_id, line_no, least(w1, w2) AS w1, greatest(w1, w2) AS w2, count(*) AS n FROM ev GROUP BY ALL""",
        "cooc_pairs_rollup": f"{_with(tok, vocab, _events(2))} {PAIRS}",
        "cooc_pairs_ref_vocab": f"{_with(tok, *ref_vocab, _events(1))} {PAIRS}",
        "cooc_directed": f"{_with(tok, vocab, _events(2))} {DIRECTED}",
        "cooc_directed_rollup": f"{_with(tok, vocab, _events(2))} {DIRECTED}",
        "stripes_ref_vocab": _stripes(1, *ref_vocab),
        "stripes_sparse": f"""{_with(tok, vocab, _events(2), f"dir AS ({DIRECTED})")},
            place AS (SELECT word, (row_number() OVER (ORDER BY word) - 1)::INTEGER AS idx FROM vocab)
            SELECT w1 AS word, idx, n FROM dir JOIN place ON word = w2""",
        "stripes_tiled": f"""{_with(tok, _counts("c", "tok"), f"vocab AS (SELECT word FROM c ORDER BY n DESC, word LIMIT {WIDE})", _events(1), f"dir AS ({DIRECTED})")},
            place AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS idx FROM vocab)
            SELECT f.w1 AS word, (p.idx // {TILE})::INTEGER AS tile, string_agg(coalesce(dir.n, 0)::VARCHAR, ', ' ORDER BY p.idx) AS cells
            FROM (SELECT DISTINCT w1 FROM dir) f CROSS JOIN place p LEFT JOIN dir ON dir.w1 = f.w1 AND dir.w2 = p.word GROUP BY ALL""",
        "cooc_pairs_many_words": f"""{_with(tok, _counts("c", "tok"), f"vocab AS (SELECT word FROM c WHERE n >= {LEAST_COUNT})", _events(1))} {PAIRS}""",
        "top50_words_in_rounds": f"{_with(tok, vocab)} SELECT word, n FROM vocab",
        "top100_df_stemmed_in_rounds": f"{df_stemmed} SELECT term, df FROM freqs {in_word_order} LIMIT {TOP_TERMS}",
        "counts_parsed": f"""{_with(_lines("l"), PARSED)}
            SELECT word, arg_max(n, idx) AS n FROM good WHERE n IS NOT NULL GROUP BY word""",
        "vocabulary_parsed": f"{_with(_lines('l'), PARSED)} SELECT DISTINCT split_part(value, chr(9), 1) AS word FROM tsv",
        "df_ranks_parsed": f"""{_with(_lines("l"), PARSED)}
            SELECT word AS term, arg_max(n, idx) AS df, max(idx)::BIGINT AS idx FROM good WHERE n IS NOT NULL GROUP BY word""",
        "stop_lists_united": f"""{_with(_lines("l"), PARSED)}
            SELECT pattern, first.list AS list, first.doc_id AS doc_id, first.line_no AS line_no FROM (
            SELECT value AS pattern, min({{'list': list, 'doc_id': doc_id, 'line_no': line_no}}) AS first FROM (
                SELECT value, 0::INTEGER AS list, doc_id, line_no FROM tsv
                UNION ALL SELECT CASE WHEN line_no % 2 = 0 THEN value || '+' ELSE value END, 1::INTEGER, doc_id, line_no FROM tsv)
            GROUP BY value)""",
        "doc_terms_distinct": f"{_with(tok)} SELECT DISTINCT doc_id, token AS term FROM tok",
        "doc_freq": f"{df} SELECT term, df FROM freqs",
        "doc_freq_stripped": f"{_with(stripped, _doc_freq('freqs', 'stripped'))} SELECT term, df FROM freqs",
        "top100_df": f"{df} SELECT term, df FROM freqs {in_word_order} LIMIT {TOP_TERMS}",
        "df_top_indexed": f"{ranked} SELECT term, df, idx FROM ranked",
        "idf": f"{ranked} SELECT term, df, round(ln({N_DOCS}::DOUBLE / (1 + df)), 6) AS idf FROM ranked",
        "tf": f"{ranked} {_tf('tok')}",
        "tf_cumulative": f"{ranked} {_tf('tok', RUNNING)}",
        "tfidf": f"{ranked}, {_tf_idf('tok', N_DOCS)}",
        "stem_dictionary": f"{_with(tok, _stems('st', 'tok'))} SELECT token, stem FROM st",
        "doc_freq_stemmed": f"{df_stemmed} SELECT term, df FROM freqs",
        "top100_df_stemmed": f"{df_stemmed} SELECT term, df FROM freqs {in_word_order} LIMIT {TOP_TERMS}",
        "top100_df_stripped_stemmed": f"{df_stripped_stemmed} SELECT term, df FROM freqs {in_word_order} LIMIT {TOP_TERMS}",
        "tf_stemmed": f"{ranked_stemmed} {_tf('stm')}",
        "tfidf_stemmed": f"{ranked_stemmed}, {_tf_idf('stm', N_DOCS)}",
        "tfidf_ref_settings": f"""{df_stripped_stemmed}, {_ranked("ranked", "freqs")},
            {tok.strip()}, {_stemmed("stm", "tok")}, {_tf_idf("stm", str(ASSUMED_DOCUMENTS), RUNNING)}""",
    }
    for d in DISTANCES:
        sql[f"cooc_pairs_d{d}"] = f"{_with(tok, vocab, _events(d))} {PAIRS}"
        sql[f"stripes_dense_d{d}"] = _stripes(d, vocab)
    return sql
