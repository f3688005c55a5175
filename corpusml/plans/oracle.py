"""Independent SQL (DuckDB dialect) for every registered query.

Written from the operator definitions, not from the Spark plans: the hex
dump and the listing are rebuilt with list functions, tokens come from RE2
(no look-around: segment titles are matched with their address and cut
back), naive Bayes is scored from its closed form with joins and an
arg-max window.  Tables: the driver's parquet views (``documents``,
``labels``, ``benchmark`` ...).
"""

from __future__ import annotations

from corpusml.functions.views import BASE_ADDRESS, BYTES_PER_LINE
from corpusml.plans.queries import COUNT_MIN_DF, ROUND, URL_BASE, VOCAB_MIN_DF, VOCAB_TOP_K, WORD_MIN_DOCS
from corpusml.plans.tables import LISTING_WORDS

OPS = "|".join(LISTING_WORDS)
NL = "chr(10)"


def hexed(text: str = "text") -> str:
    return f"hex(encode({text}))"


def hex_dump(text: str = "text") -> str:
    chunks = f"regexp_extract_all({hexed(text)}, '.{{1,{2 * BYTES_PER_LINE}}}', 0)"
    lines = (f"list_transform({chunks}, lambda c, i: "
             f"lpad(hex({BASE_ADDRESS} + (i - 1) * {BYTES_PER_LINE}), 8, '0') || "
             f"regexp_replace(c, '(..)', ' \\1', 'g'))")
    return f"array_to_string({lines}, {NL})"


def listing(text: str = "text") -> str:
    return (f"array_to_string(list_transform(string_split({text}, {NL}), lambda line, i: "
            f"(CASE WHEN i = 1 THEN 'HEADER:' ELSE '.text:' END) || "
            f"lpad(hex({BASE_ADDRESS} + (i - 1) * {BYTES_PER_LINE}), 8, '0') || ' ' || line), {NL})")


def _low(expr: str, lowercase: bool) -> str:
    return f"lower({expr})" if lowercase else expr


def byte_tokens(text: str = "text", lowercase: bool = False) -> str:
    # Every byte of the dump is preceded by a blank; addresses never are.
    spaced = f"regexp_replace({_low(hexed(text), lowercase)}, '(..)', ' \\1', 'g')"
    return f"regexp_extract_all({spaced}, ' ([0-9A-F]{{2}})', 1)"


def _cut_segments(tokens: str) -> str:
    return f"list_transform({tokens}, lambda t: regexp_replace(t, ':[0-9A-F]{{8}}\\s$', ':'))"


SEGMENT_RE2 = r"(\.?\w+:[0-9A-F]{8}\s)"
WORDS_RE2 = rf"\b({OPS})\b"
WORD_RE2 = r"\w+"
PAIR_RE2 = r"(\b[0-9A-F]{2} [0-9A-F]{2}\b)"


def asm_tokens(text: str = "text", lowercase: bool = False) -> str:
    src = _low(listing(text), lowercase)
    return _cut_segments(f"regexp_extract_all({src}, '{SEGMENT_RE2}|{WORDS_RE2}', 0)")


def joint_tokens(text: str = "text", lowercase: bool = False) -> str:
    src = _low(f"({hex_dump(text)} || {NL} || {NL} || {listing(text)})", lowercase)
    return _cut_segments(f"regexp_extract_all({src}, '{PAIR_RE2}|{SEGMENT_RE2}|{WORDS_RE2}', 0)")


TOKENS = {"bytes": byte_tokens, "asm": asm_tokens, "joint": joint_tokens}


def grams(lst: str, n: int) -> str:
    if n == 1:
        return lst
    shifted = ", ".join([lst] + [f"{lst}[{k + 1}:]" for k in range(1, n)])
    joined = " || ' ' || ".join(f"s[{k + 1}]" for k in range(n))
    return (f"list_filter(list_transform(list_zip({shifted}), lambda s: {joined}), "
            f"lambda g: g IS NOT NULL)")


def corpus_cte(kind: str = "bytes", lowercase: bool = False, ngram: int = 1) -> str:
    """CTEs ``doc(id, label, toks)``, ``train``, ``test``."""
    return f"""doc0 AS (SELECT doc_id AS id, lang AS label, {TOKENS[kind]('text', lowercase)} AS t0
                FROM documents),
doc AS (SELECT id, label, {grams('t0', ngram)} AS toks FROM doc0),
train AS (SELECT * FROM doc WHERE id % 5 <> 0),
test AS (SELECT * FROM doc WHERE id % 5 = 0)"""


def token_counts(kind: str, lowercase: bool = False) -> str:
    return f"""SELECT token, count(*) AS cnt FROM (
  SELECT unnest({TOKENS[kind]('text', lowercase)}) AS token FROM documents) GROUP BY token"""


COUNT_VOCABULARY = f"""vocab AS (SELECT term FROM (SELECT id, unnest(toks) AS term FROM train)
          GROUP BY term HAVING count(DISTINCT id) >= {COUNT_MIN_DF})"""

CLASSES = """classes AS (SELECT label, count(*) AS n,
                   CAST(row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS DOUBLE) AS ix
            FROM train WHERE label IS NOT NULL GROUP BY label)"""


def nb_model_cte(idf: bool) -> str:
    w = ("ln(((SELECT count(*) FROM trn) + 1.0) / (df + 1.0))" if idf else "1.0")
    return f"""{CLASSES},
trn AS (SELECT t.id, c.ix, t.toks FROM train t JOIN classes c ON t.label = c.label),
ttok AS (SELECT id, ix, unnest(toks) AS term FROM trn),
vocab AS (SELECT term, count(DISTINCT id) AS df FROM ttok GROUP BY term),
nv AS (SELECT count(*) AS v FROM vocab),
w AS (SELECT term, {w} AS w FROM vocab),
ct AS (SELECT ix, term, sum(w.w) AS tf, count(*) AS cnt FROM ttok JOIN w USING (term) GROUP BY ix, term),
den AS (SELECT ix, ln(sum(tf) + (SELECT v FROM nv)) AS logden FROM ct GROUP BY ix),
prior AS (SELECT ix, label, n AS n_docs,
                 ln(n + 1.0) - ln((SELECT sum(n) FROM classes) + (SELECT count(*) FROM classes)) AS pi
          FROM classes)"""


def nb_predictions_cte(idf: bool) -> str:
    return f"""{nb_model_cte(idf)},
qtok AS (SELECT id, unnest(toks) AS term FROM test),
qw AS (SELECT q.id, q.term, count(*) * any_value(w.w) AS x FROM qtok q JOIN w USING (term)
       GROUP BY q.id, q.term),
qn AS (SELECT id, sum(x) AS n FROM qw GROUP BY id),
hit AS (SELECT qw.id, ct.ix, sum(qw.x * ln(ct.tf + 1.0)) AS s FROM qw JOIN ct USING (term)
        GROUP BY qw.id, ct.ix),
score AS (SELECT t.id, p.ix, p.pi + coalesce(h.s, 0.0)
                 - coalesce(qn.n, 0.0) * coalesce(d.logden, ln((SELECT v FROM nv))) AS raw
          FROM test t CROSS JOIN prior p
          LEFT JOIN hit h ON h.id = t.id AND h.ix = p.ix
          LEFT JOIN qn ON qn.id = t.id
          LEFT JOIN den d ON d.ix = p.ix),
best AS (SELECT id, ix, row_number() OVER (PARTITION BY id ORDER BY raw DESC, ix) AS r FROM score),
pred AS (SELECT b.id, b.ix AS prediction, c.label AS predictedClass
         FROM best b JOIN classes c ON b.ix = c.ix WHERE b.r = 1)"""


def nb_predict(kind="bytes", idf=False, ngram=1) -> str:
    return f"""WITH {corpus_cte(kind, ngram=ngram)},
{nb_predictions_cte(idf)}
SELECT id, prediction, predictedClass FROM pred"""


def nb_accuracy(kind="bytes", idf=False, ngram=1, evaluator=False) -> str:
    cmp = "CAST(c.ix AS DOUBLE) = p.prediction" if evaluator else "t.label = p.predictedClass"
    return f"""WITH {corpus_cte(kind, ngram=ngram)},
{nb_predictions_cte(idf)}
SELECT avg(CASE WHEN {cmp} THEN 1.0 ELSE 0.0 END) AS accuracy
FROM test t JOIN classes c ON t.label = c.label JOIN pred p ON p.id = t.id"""


def _lines(text: str = "text") -> str:
    body = f"regexp_replace({text}, '(\\r\\n|\\n|\\r)$', '')"
    return f"(CASE WHEN {text} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({body}, '\\r\\n|\\n|\\r') END)"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["line_index"] = f"""SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS line_no,
       unnest(l) AS line FROM (SELECT doc_id, {_lines()} AS l FROM documents)"""
    q["global_line_index"] = f"""WITH l AS (
  SELECT doc_id, generate_subscripts(l, 1) AS n, unnest(l) AS line FROM (SELECT doc_id, {_lines()} AS l FROM documents))
SELECT row_number() OVER (ORDER BY doc_id, n) - 1 AS id, line FROM l"""
    q["manifest_scan"] = """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, md5(text) AS hash, n_chars AS label
FROM documents"""
    q["document_url"] = f"""SELECT doc_id, md5(text) AS hash,
       '{URL_BASE}/bytes/' || md5(text) || '.bytes' AS url FROM documents"""
    q["int_parse"] = """SELECT doc_id, CAST(trim(' ' || CAST(quality * 2 + toxic AS VARCHAR) || chr(9), ' ' || chr(9))
       AS BIGINT) AS label FROM labels"""
    q["labelled_corpus"] = """SELECT d.doc_id AS id, CAST(strlen(d.text) AS BIGINT) AS n_tokens, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""
    q["manifest_restrict"] = """SELECT doc_id AS id, md5(text) AS hash, n_chars FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels)"""
    q["manifest_filter"] = """SELECT doc_id AS id, md5(doc_id::VARCHAR) AS hash, CAST(strlen(text) AS BIGINT) AS n_tokens
FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"""
    q["corpus_union"] = """SELECT 'documents' AS corpus, doc_id AS id, CAST(strlen(text) AS BIGINT) AS n_tokens FROM documents
UNION ALL
SELECT 'benchmark' AS corpus, item_id AS id, CAST(strlen(text) AS BIGINT) AS n_tokens FROM benchmark"""
    q["byte_token_counts"] = token_counts("bytes")
    q["asm_token_counts"] = token_counts("asm")
    q["joint_token_counts"] = token_counts("joint")
    q["joint_corpus_buckets"] = f"""SELECT id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id AS id, {joint_tokens()} AS t FROM documents)"""
    q["lowercase_effect"] = "\nUNION ALL\n".join(
        f"SELECT '{k}' AS kind, token, cnt FROM ({token_counts(k, True)})" for k in ("bytes", "asm", "joint"))
    q["ngram_counts"] = f"""WITH d AS (SELECT {byte_tokens()} AS t FROM documents)
SELECT n, gram, count(*) AS cnt FROM (
  SELECT CAST(1 AS BIGINT) AS n, unnest({grams('t', 1)}) AS gram FROM d
  UNION ALL SELECT CAST(2 AS BIGINT), unnest({grams('t', 2)}) FROM d
  UNION ALL SELECT CAST(3 AS BIGINT), unnest({grams('t', 3)}) FROM d) GROUP BY n, gram"""
    q["vocabulary_topk"] = f"""WITH {corpus_cte('bytes', ngram=2)},
st AS (SELECT term, count(*) AS tf, count(DISTINCT id) AS df
       FROM (SELECT id, unnest(toks) AS term FROM train) GROUP BY term)
SELECT CAST(row_number() OVER (ORDER BY tf DESC, term) - 1 AS BIGINT) AS ix, term, tf, df
FROM st WHERE df >= {VOCAB_MIN_DF} ORDER BY tf DESC, term LIMIT {VOCAB_TOP_K}"""
    q["term_counts"] = f"""WITH {corpus_cte()},
{COUNT_VOCABULARY}
SELECT id, term, count(*) AS cnt FROM (SELECT id, unnest(toks) AS term FROM doc) JOIN vocab USING (term)
GROUP BY id, term"""
    q["rf_features"] = f"""WITH {corpus_cte('joint')},
{COUNT_VOCABULARY}
SELECT id, term, count(*) AS cnt FROM (SELECT id, unnest(toks) AS term FROM doc) JOIN vocab USING (term)
GROUP BY id, term"""
    idf = f"""WITH {corpus_cte()},
m AS (SELECT count(*) AS m FROM train),
st AS (SELECT term, count(DISTINCT id) AS df FROM (SELECT id, unnest(toks) AS term FROM train) GROUP BY term),
idf AS (SELECT term, df, ln(((SELECT m FROM m) + 1.0) / (df + 1.0)) AS idf FROM st)"""
    q["idf_weights"] = f"{idf}\nSELECT term, df, round(idf, {ROUND}) AS idf FROM idf"
    q["tfidf"] = f"""{idf},
tc AS (SELECT id, term, count(*) AS cnt FROM (SELECT id, unnest(toks) AS term FROM doc) GROUP BY id, term)
SELECT tc.id, tc.term, round(tc.cnt * idf.idf, {ROUND}) AS tfidf FROM tc JOIN idf USING (term)
WHERE idf.df >= {COUNT_MIN_DF}"""
    q["term_counts_uncapped"], q["tfidf_uncapped"] = q["term_counts"], q["tfidf"]
    q["asm_vocabulary_table"] = f"""WITH w AS (
  SELECT word FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{WORD_RE2}')) AS word FROM documents)
  WHERE regexp_matches(word, '^[A-Za-z_]') GROUP BY word HAVING count(DISTINCT doc_id) >= {WORD_MIN_DOCS}),
l AS (SELECT doc_id AS id, {_cut_segments(f"regexp_extract_all({listing()}, '{SEGMENT_RE2}|{WORD_RE2}', 0)")} AS t FROM documents),
p AS (SELECT id, generate_subscripts(t, 1) AS pos, unnest(t) AS token FROM l),
k AS (SELECT * FROM p WHERE token LIKE '%:' OR token IN (SELECT word FROM w))
SELECT l.id, count(k.pos) AS n_tokens, md5(coalesce(string_agg(token, ' ' ORDER BY pos), '')) AS tokens_md5
FROM l LEFT JOIN k ON l.id = k.id GROUP BY l.id"""
    q["rf_root_splits"] = f"""WITH {corpus_cte('joint')},
{COUNT_VOCABULARY},
{CLASSES},
tc AS (SELECT id, term, label, count(*) AS v FROM (SELECT id, label, unnest(toks) AS term FROM train)
       JOIN vocab USING (term) GROUP BY ALL),
seen AS (SELECT term, v, label, count(*) AS n FROM tc GROUP BY ALL),
vals AS (SELECT DISTINCT term, v FROM seen UNION SELECT term, 0 FROM vocab),
cells AS (
  SELECT t.term, t.v, c.label, CASE WHEN t.v = 0 THEN c.n - coalesce((SELECT sum(s.n) FROM seen s
    WHERE s.term = t.term AND s.label = c.label), 0) ELSE coalesce(s.n, 0) END AS n
  FROM vals t CROSS JOIN classes c LEFT JOIN seen s ON s.term = t.term AND s.v = t.v AND s.label = c.label),
used AS (SELECT * FROM cells JOIN (SELECT term, v FROM cells GROUP BY ALL HAVING sum(n) > 0) USING (term, v)),
cum AS (SELECT term, v, label, sum(n) OVER (PARTITION BY term, label ORDER BY v) AS l FROM used),
tot AS (SELECT sum(n) AS n, 1 - sum(n * n) / (sum(n) * sum(n))::DOUBLE AS gini FROM classes),
sides AS (
  SELECT term, v, sum(l) AS nl, any_value(tot.n) - sum(l) AS nr, sum(l * l) AS ll,
         sum((classes.n - l) * (classes.n - l)) AS rr, any_value(tot.n) AS n, any_value(gini) AS gini
  FROM cum JOIN classes USING (label), tot GROUP BY term, v),
bins AS (SELECT *, ((nl - 1) * 32) // n AS bin FROM sides),
cuts AS (SELECT *, lead(bin) OVER (PARTITION BY term ORDER BY v) AS following FROM bins),
gains AS (
  SELECT term, v, nl, round(gini - nl / n * (1 - ll / (nl * nl)::DOUBLE) - nr / n * (1 - rr / (nr * nr)::DOUBLE), 9) AS gain
  FROM cuts WHERE following > bin),
best AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY gain DESC, v) AS r FROM gains)
SELECT term, v AS threshold, nl::BIGINT AS n_left, round(gain, {ROUND}) AS gain FROM best WHERE r = 1"""
    q["label_index"] = f"WITH {corpus_cte()},\n{CLASSES}\nSELECT label, n, ix FROM classes"
    q["label_decode"] = f"""WITH {corpus_cte()},
{CLASSES}
SELECT t.id, c.ix AS indexedLabel, c.label AS decoded FROM doc t JOIN classes c ON t.label = c.label"""
    q["rf_label_index"] = f"""WITH {corpus_cte()},
{CLASSES}
SELECT t.label, c.ix AS indexedLabel, count(*) AS n FROM doc t JOIN classes c ON t.label = c.label GROUP BY ALL"""
    q["unseen_class_skip"] = f"""WITH doc AS (SELECT doc_id AS id,
    CASE WHEN doc_id % 5 = 0 AND doc_id % 3 = 0 THEN 'new' ELSE lang END AS label FROM documents),
train AS (SELECT * FROM doc WHERE id % 5 <> 0),
test AS (SELECT * FROM doc WHERE id % 5 = 0),
{CLASSES}
SELECT t.id, t.label, c.ix AS indexedLabel FROM test t JOIN classes c ON t.label = c.label"""
    q["unseen_label_skip"] = """WITH doc AS (SELECT d.doc_id AS id, CAST(l.quality AS BIGINT) AS label
             FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
train AS (SELECT * FROM doc WHERE id % 5 <> 0),
test AS (SELECT * FROM doc WHERE id % 5 = 0),
classes AS (SELECT CAST(label AS VARCHAR) AS slabel,
                   CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(label AS VARCHAR)) - 1 AS DOUBLE) AS ix
            FROM train WHERE label IS NOT NULL GROUP BY label)
SELECT t.id, t.label, c.ix AS indexedLabel FROM test t JOIN classes c ON CAST(t.label AS VARCHAR) = c.slabel"""
    q["nb_priors"] = f"""WITH {corpus_cte()},
{nb_model_cte(False)}
SELECT p.ix, p.label, p.n_docs, round(p.pi, {ROUND}) AS pi,
       round(-coalesce(d.logden, ln((SELECT v FROM nv))), {ROUND}) AS unseen_theta
FROM prior p LEFT JOIN den d ON p.ix = d.ix"""
    q["nb_theta"] = f"""WITH {corpus_cte()},
{nb_model_cte(False)}
SELECT ct.ix, ct.term, ct.cnt AS tf, round(ln(ct.tf + 1.0) - d.logden, {ROUND}) AS theta
FROM ct JOIN den d ON ct.ix = d.ix"""
    q["nb_predict"] = nb_predict()
    q["nb_predict_sparse"] = nb_predict()
    q["nb_job_files"] = f"SELECT id, predictedClass FROM ({nb_predict()})"
    q["nb_predict_tfidf"] = nb_predict(idf=True)
    q["nb_predict_bigrams"] = nb_predict(idf=True, ngram=2)
    q["nb_predict_asm"] = nb_predict(kind="asm")
    q["ordered_predictions"] = f"""SELECT row_number() OVER (ORDER BY id) - 1 AS line, predictedClass
FROM ({nb_predict()})"""
    q["nb_accuracy"] = nb_accuracy()
    q["evaluator_accuracy"] = nb_accuracy(idf=True, ngram=2, evaluator=True)
    q["token_preview"] = f"""WITH {corpus_cte('joint')}
SELECT id, CAST(len(toks) AS BIGINT) AS n_tokens, array_to_string(toks, ' ') AS tokens
FROM train ORDER BY id LIMIT 20"""
    # rf_predict / rf_accuracy: a forest is not expressible in SQL (rows-only check).
    return q
