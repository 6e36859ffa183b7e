"""Independent SQL for the registered queries, written for DuckDB.

The steps are spelt out one by one here (dictionaries are applied in turn, scores are computed for all
pairs), so that a shortcut of a query is checked against the plain definition.
"""

from __future__ import annotations

from catalogue import parameters as P

PUNCTUATION = r"""[!"#$%&''()*+,\-./:;<=>?@\[\]^_`{|}~]"""
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
WHITESPACE = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)


def clean(t: str) -> str:
    t = f"regexp_replace(lower(coalesce({t}, '')), '{PUNCTUATION}', '', 'g')"
    for _ in range(2):  # neighbouring matches share a separator
        t = rf"regexp_replace({t}, '(^|{NOT_WORD})(g|ml)($|{NOT_WORD})', '\1\3', 'g')"
    t = f"trim(regexp_replace({t}, '{WHITESPACE}+', ' ', 'g'))"
    return f"regexp_replace({t}, '^[•●·–—]+', '')"


def english(t: str) -> str:
    return f"length(regexp_replace({t}, '[^a-z]', '', 'g')) > length(regexp_replace({t}, '[^à-ỹ]', '', 'g'))"


def ws(t: str) -> str:
    return f"regexp_extract_all({t}, '[^ ]+')"


def words(t: str) -> str:
    return f"regexp_extract_all(lower({t}), '{WORD}{{2,}}')"


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pairs(name: str, mapping: dict) -> str:
    rows = ", ".join(f"({quoted(a)}, {quoted(b) if isinstance(b, str) else b})" for a, b in mapping.items())
    return f"{name}(term, replacement) AS (VALUES {rows})"


def normalized(base: str, prefix: str = "") -> str:
    """CTEs from ``base`` (k, text) to ``{prefix}kept`` (k, p, q, r, w) and ``{prefix}norm`` (k, normalized)."""
    dropped = ", ".join(quoted(w) for w in P.WRONG + P.STOP)
    x = prefix
    return f"""
{x}cleaned AS (SELECT k, {clean("text")} AS c FROM {base}),
{x}gate AS (SELECT k, {english("c")} AS en, {ws("c")} AS t FROM {x}cleaned),
{x}tok AS (SELECT k, en, unnest(t) AS w, generate_subscripts(t, 1) AS p FROM {x}gate),
{x}translated AS (SELECT k, p, string_split(CASE WHEN en THEN coalesce(e.replacement, w) ELSE w END, ' ') AS t
  FROM {x}tok LEFT JOIN english_map e ON e.term = w),
{x}tok2 AS (SELECT k, p, unnest(t) AS w, generate_subscripts(t, 1) AS q FROM {x}translated),
{x}slang AS (SELECT k, p, q, string_split(coalesce(s.replacement, w), ' ') AS t
  FROM {x}tok2 LEFT JOIN slang_map s ON s.term = w),
{x}tok3 AS (SELECT k, p, q, unnest(t) AS w, generate_subscripts(t, 1) AS r FROM {x}slang),
{x}kept AS (SELECT * FROM {x}tok3 WHERE w NOT IN ({dropped})),
{x}norm AS (SELECT b.k, coalesce(string_agg(w, ' ' ORDER BY p, q, r), '') AS normalized
  FROM {base} b LEFT JOIN {x}kept USING (k) GROUP BY b.k)"""


MAPS = f"{pairs('english_map', P.ENGLISH)}, {pairs('slang_map', P.SLANG)}"

ALL_TEXTS = """all_texts AS (
  SELECT 'document' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'turn', conv_id * 1000 + turn, text FROM conversations
  UNION ALL SELECT 'accents', conv_id * 1000 + turn, regexp_replace(lower(text), '[a-z]', '', 'g') FROM conversations)"""

IDF = {
    "log2": "log2((SELECT count(*) FROM docs) / df)",
    "smooth": "ln((1.0 + (SELECT count(*) FROM docs)) / (1 + df)) + 1",
}


def weights(tokens: str, formula: str, max_terms: int | None = None) -> str:
    """CTEs from ``docs`` (id) and ``tokens`` (id, term) to tf, vocab and unit-length weights."""
    cap = ""
    if max_terms:
        cap = f"WHERE term IN (SELECT term FROM tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT {max_terms})"
    return f"""
tf AS (SELECT id, term, count(*) AS tf FROM {tokens} GROUP BY id, term),
dfs AS (SELECT term, count(*) AS df FROM tf {cap} GROUP BY term),
vocab AS (SELECT term, df, {IDF[formula]} AS idf FROM dfs),
raw AS (SELECT id, term, tf * idf AS w FROM tf JOIN vocab USING (term) WHERE idf > 1e-12),
norms AS (SELECT id, sqrt(sum(w * w)) AS n FROM raw GROUP BY id),
weights AS (SELECT id, term, w / n AS w FROM raw JOIN norms USING (id))"""


def request_weights(tokens: str) -> str:
    return f"""
qtf AS (SELECT rid, term, count(*) AS tf FROM {tokens} GROUP BY rid, term),
qraw AS (SELECT rid, term, tf * idf AS w FROM qtf JOIN vocab USING (term) WHERE idf > 1e-12),
qnorms AS (SELECT rid, sqrt(sum(w * w)) AS n FROM qraw GROUP BY rid),
qweights AS (SELECT rid, term, w / n AS w FROM qraw JOIN qnorms USING (rid)),
dots AS (SELECT rid, id, sum(q.w * d.w) AS sim FROM qweights q JOIN weights d USING (term) GROUP BY rid, id)"""


RAW_DOCS = f"""docs AS (SELECT doc_id AS id, text FROM documents),
dtok AS (SELECT id, unnest({words("text")}) AS term FROM docs)"""


def corpus(model: str) -> str:
    base = f"docs AS (SELECT doc_id AS id, doc_id AS k, text FROM documents), {normalized('docs', 'd_')}"
    if model == "A":
        return base + ", dtok AS (SELECT k AS id, w AS term FROM d_kept)"
    return base + f", dtok AS (SELECT k AS id, unnest({words('normalized')}) AS term FROM d_norm)"


def ranked(requests: str, model: str, places: int, top_n: str, where: str = "true") -> str:
    """All documents of every request, ranked: the plain definition with its zero scores."""
    tie = "ASC" if model == "A" else "DESC"
    return f"""
scored AS (SELECT r.rid, r.top_n, d.id, coalesce(s.sim, 0.0) AS sim
  FROM (SELECT rid, {top_n} AS top_n FROM {requests}) r CROSS JOIN docs d LEFT JOIN dots s ON s.rid = r.rid AND s.id = d.id
  WHERE {where}),
best AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY round(sim, 10) DESC, id {tie}) AS rank FROM scored)
SELECT rid AS request_id, CAST(rank AS INTEGER) AS rank, id, round(sim, {places}) AS similarity FROM best WHERE rank <= top_n"""


def search(model: str) -> str:
    formula, places = ("log2", 4) if model == "A" else ("smooth", 6)
    req = f"req AS (SELECT item_id AS rid, item_id AS k, text FROM benchmark), {normalized('req', 'q_')}"
    if model == "A":
        qtok = "qtok AS (SELECT k AS rid, w AS term FROM q_kept)"
    else:
        qtok = f"qtok AS (SELECT k AS rid, unnest({words('normalized')}) AS term FROM q_norm)"
    return (
        f"WITH {MAPS}, {corpus(model)}, {weights('dtok', formula)}, {req}, {qtok}, {request_weights('qtok')}, "
        + ranked("req", model, places, "5")
    )


def search_padded(model: str) -> str:
    formula, places = ("log2", 4) if model == "A" else ("smooth", 6)
    return f"""WITH {MAPS}, {corpus(model)}, {weights("dtok", formula)},
words AS (SELECT item_id AS rid, unnest({words("text")}) AS term FROM benchmark),
longest AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY length(term) DESC, term) AS k FROM words),
qtok AS (SELECT rid, term FROM longest WHERE k = 1), {request_weights("qtok")},
{ranked("qtok", model, places, "rid % 10 + 1")}"""


def find_similar(model: str) -> str:
    formula, places = ("log2", 4) if model == "A" else ("smooth", 6)
    return f"""WITH {MAPS}, {corpus(model)}, {weights("dtok", formula)},
req AS (SELECT doc_id AS rid FROM labels),
dots AS (SELECT q.id AS rid, d.id, sum(q.w * d.w) AS sim
  FROM weights q JOIN req ON req.rid = q.id JOIN weights d USING (term) GROUP BY q.id, d.id),
{ranked("req", model, places, "5", "r.rid <> d.id")}"""


CUSTOMER_PROFILES = f"""profiles AS (SELECT c_custkey AS id, concat_ws(' ', c_mktsegment, n_name, r_name) AS profile
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
docs AS (SELECT id, profile FROM profiles),
dtok AS (SELECT id, unnest({ws(clean("profile"))}) AS term FROM docs)"""


def similar_profiles(model: str) -> str:
    formula, places = ("log2", 4) if model == "A" else ("smooth", 6)
    return f"""WITH {CUSTOMER_PROFILES}, {weights("dtok", formula)},
dots AS (SELECT q.id AS rid, d.id, sum(q.w * d.w) AS sim FROM weights q JOIN weights d USING (term) GROUP BY q.id, d.id),
req AS (SELECT id AS rid FROM docs),
{ranked("req", model, places, "5", "r.rid <> d.id")}"""


def similar_pairs(docs: str, formula: str, places: int) -> str:
    """``docs``: CTEs that end in docs (id, profile) and dtok. Copies are kept apart until the last step."""
    return f"""WITH {docs}, {weights("dtok", formula)},
groups AS (SELECT profile, min(id) AS id, count(*) AS n FROM docs GROUP BY profile),
one AS (SELECT w.id, term, w FROM weights w JOIN groups g ON g.id = w.id),
dots AS (SELECT a.id AS id_a, b.id AS id_b, sum(a.w * b.w) AS sim
  FROM one a JOIN one b ON a.term = b.term AND a.id < b.id GROUP BY a.id, b.id)
SELECT id_a, id_b, round(sim, {places}) AS similarity, ga.n AS n_a, gb.n AS n_b
FROM dots JOIN groups ga ON ga.id = id_a JOIN groups gb ON gb.id = id_b WHERE round(sim, 10) > 0.5
UNION ALL SELECT id, id, 1.0, n, n FROM groups WHERE n > 1 AND id IN (SELECT id FROM one)"""


def pairs_text() -> str:
    docs = f"""{MAPS}, texts AS (SELECT doc_id AS k, text FROM documents), {normalized("texts", "d_")},
docs AS (SELECT k AS id, normalized AS profile FROM d_norm),
dtok AS (SELECT k AS id, w AS term FROM d_kept)"""
    return similar_pairs(docs, "smooth", 6)


def retrieve(threshold: float) -> str:
    return f"""WITH {RAW_DOCS}, {weights("dtok", "smooth", 500)},
langs(cluster) AS (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL),
req AS (SELECT item_id || '-' || cluster AS rid, cluster, text FROM benchmark, langs),
qtok AS (SELECT rid, unnest({words("text")}) AS term FROM req), {request_weights("qtok")},
scored AS (SELECT r.rid, r.cluster, d.doc_id AS id, coalesce(s.sim, 0.0) AS sim
  FROM req r JOIN documents d ON d.lang = r.cluster LEFT JOIN dots s ON s.rid = r.rid AND s.id = d.doc_id
  WHERE round(coalesce(s.sim, 0.0), 10) >= {threshold}),
best AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY round(sim, 10) DESC, id) AS rank FROM scored)"""


def recommend(threshold: float) -> str:
    return f"""{retrieve(threshold)}
SELECT rid AS request_id, CAST(rank AS INTEGER) AS rank, id, id + 1 AS display_no, cluster AS predicted_cluster,
  round(sim, 6) AS similarity_score FROM best WHERE rank <= 10"""


def mixed_requests() -> str:
    """Three spaces (A, B, R) side by side; every company of every request is scored, then each request's rules apply."""
    formula = "CASE WHEN space = 'A' THEN {} ELSE {} END".format(IDF["log2"], IDF["smooth"])
    return f"""WITH {MAPS}, docs AS (SELECT doc_id AS id, doc_id AS k, lang, source, text FROM documents), {normalized("docs", "d_")},
dtok AS (SELECT 'A' AS space, k AS id, w AS term FROM d_kept
  UNION ALL SELECT s, k, unnest({words("normalized")}) FROM d_norm, (SELECT unnest(['B', 'R']) AS s)),
tf AS (SELECT space, id, term, count(*) AS tf FROM dtok GROUP BY space, id, term),
capped AS (SELECT term FROM tf WHERE space = 'R' GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 500),
dfs AS (SELECT space, term, count(*) AS df FROM tf WHERE space <> 'R' OR term IN (SELECT term FROM capped) GROUP BY space, term),
vocab AS (SELECT space, term, {formula} AS idf FROM dfs),
raw AS (SELECT space, id, term, tf * idf AS w FROM tf JOIN vocab USING (space, term) WHERE idf > 1e-12),
weights AS (SELECT space, id, term, w / sqrt(sum(w * w) OVER (PARTITION BY space, id)) AS w FROM raw),
langs AS (SELECT list_sort(list(DISTINCT lang)) AS l FROM documents WHERE lang IS NOT NULL),
asked AS (SELECT conv_id * 1000 + turn AS rid, CASE WHEN turn % 3 = 2 THEN 'recommend' ELSE 'similar' END AS job,
  CASE WHEN conv_id % 2 = 0 THEN 'A' ELSE 'B' END AS model, CASE WHEN role = 'user' THEN text ELSE ' ' END AS text,
  CASE WHEN role <> 'system' THEN conv_id END AS company, conv_id % 10 + 1 AS top_n, l[conv_id % len(l) + 1] AS cluster,
  CASE conv_id % 7 WHEN 0 THEN 0.0 WHEN 1 THEN {P.STRICT_THRESHOLD} ELSE 0.1 END AS threshold FROM conversations, langs),
routes AS (SELECT *, rid AS k, CASE WHEN trim(text) <> '' AND job = 'recommend' THEN 'recommend'
  WHEN trim(text) <> '' THEN 'search' WHEN job = 'similar' AND company IS NOT NULL THEN 'find' ELSE 'rejected' END AS route FROM asked),
req AS (SELECT *, CASE WHEN route = 'recommend' THEN 'R' ELSE model END AS space FROM routes),
q_texts AS (SELECT k, text FROM req WHERE route IN ('search', 'recommend')), {normalized("q_texts", "q_")},
qtok AS (SELECT k AS rid, w AS term FROM q_kept JOIN req USING (k) WHERE space = 'A'
  UNION ALL SELECT k, unnest({words("normalized")}) FROM q_norm JOIN req USING (k) WHERE space <> 'A'),
qraw AS (SELECT rid, space, term, count(*) * any_value(idf) AS w FROM qtok JOIN req USING (rid) JOIN vocab USING (space, term)
  WHERE idf > 1e-12 GROUP BY rid, space, term),
qw AS (SELECT rid, space, term, w / sqrt(sum(w * w) OVER (PARTITION BY rid)) AS w FROM qraw
  UNION ALL SELECT rid, space, term, w FROM req JOIN weights USING (space) WHERE route = 'find' AND company = weights.id),
dots AS (SELECT rid, id, sum(qw.w * d.w) AS sim FROM qw JOIN weights d USING (space, term) GROUP BY rid, id),
met AS (SELECT r.rid, r.space, r.route, r.top_n, r.threshold, d.id, d.lang, d.source FROM req r JOIN docs d
  ON route = 'search' OR (route = 'find' AND company IN (SELECT id FROM docs) AND d.id <> company) OR (route = 'recommend' AND lang = cluster)),
scored AS (SELECT met.*, coalesce(sim, 0.0) AS sim FROM met LEFT JOIN dots USING (rid, id)),
best AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY round(sim, 10) DESC, CASE WHEN space = 'B' THEN -id ELSE id END) AS rank
  FROM scored WHERE route <> 'recommend' OR round(sim, 10) >= threshold),
kept AS (SELECT *, count(*) OVER (PARTITION BY rid) AS n FROM best WHERE rank <= CASE WHEN route = 'recommend' THEN 10 ELSE top_n END)
SELECT r.rid AS request_id, r.route, CASE WHEN r.route = 'rejected' THEN 'rejected' WHEN n IS NULL THEN 'unmatched' ELSE 'found' END AS status,
  CAST(coalesce(n, 0) AS INTEGER) AS matches, CASE WHEN r.route = 'recommend' THEN cluster END AS predicted_cluster,
  CAST(rank AS INTEGER) AS rank, id, round(sim, CASE WHEN r.space = 'A' THEN 4 ELSE 6 END) AS similarity,
  CASE WHEN id IS NULL THEN NULL WHEN r.route = 'recommend' THEN printf('%.3f', sim)
    WHEN r.space = 'A' THEN printf('%.4f', round(sim, 4)) ELSE printf('%.4f', sim) END AS similarity_text,
  CASE WHEN r.route = 'recommend' THEN id + 1 END AS display_no, lang, source
FROM req r LEFT JOIN kept ON r.rid = kept.rid"""


TRAIN = "CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80"

SPLIT = f"""train AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings WHERE {TRAIN}),
test AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings WHERE NOT {TRAIN})"""

NEAREST = f"""{SPLIT},
near AS (SELECT a.id, a.label AS truth, b.label,
  row_number() OVER (PARTITION BY a.id ORDER BY round(list_distance(a.v, b.v), 8), b.id) AS rank FROM test a CROSS JOIN train b)"""


def voted(k: int, name: str) -> str:
    return f"""{name}_n AS (SELECT id, truth, label, count(*) AS n FROM near WHERE rank <= {k} GROUP BY id, truth, label),
{name}_r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, label) AS r FROM {name}_n),
{name} AS (SELECT id, truth AS label, label AS prediction FROM {name}_r WHERE r = 1)"""


def centroid(source: str, out: str) -> str:
    return f"""{out}_d AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM {source}),
{out}_m AS (SELECT label, p, avg(x) AS x FROM {out}_d GROUP BY label, p),
{out} AS (SELECT label, list(x ORDER BY p) AS c FROM {out}_m GROUP BY label)"""


FAMILY = f"""WITH {NEAREST}, {voted(1, "v1")}, {voted(3, "v3")}, {voted(5, "v5")}, {centroid("train", "centres")},
closest AS (SELECT t.id, t.label, c.label AS prediction,
  row_number() OVER (PARTITION BY t.id ORDER BY round(list_distance(t.v, c.c), 8), c.label) AS rank FROM test t CROSS JOIN centres c),
results AS (
  SELECT 'neighbours' AS family, 'KNN 1' AS model, avg(CAST(label = prediction AS DOUBLE)) AS accuracy FROM v1
  UNION ALL SELECT 'neighbours', 'KNN 3', avg(CAST(label = prediction AS DOUBLE)) FROM v3
  UNION ALL SELECT 'neighbours', 'KNN 5', avg(CAST(label = prediction AS DOUBLE)) FROM v5
  UNION ALL SELECT 'centroids', 'Nearest centroid', avg(CAST(label = prediction AS DOUBLE)) FROM closest WHERE rank = 1)"""

CUSTOMERS = """customers AS (SELECT c_custkey AS id, r_name,
  CASE WHEN c_acctbal > 9000 THEN 'UNSEEN' WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

COMPANIES = """companies AS (SELECT d.doc_id AS id, lang AS company_type, source AS company_industry,
  CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 3000 THEN 'medium' ELSE 'long' END AS company_size,
  upper(lang) AS country, CAST(quality AS VARCHAR) AS working_days, CAST(toxic AS VARCHAR) AS overtime_policy
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

SIX = ["company_type", "company_industry", "company_size", "country", "working_days", "overtime_policy"]


def one_hot_wide() -> str:
    segments = [f"CAST(coalesce(segment = '{s}', false) AS INTEGER) AS \"c_mktsegment_{s}\"" for s in P.SEGMENTS]
    regions = [f"CAST(r_name = '{r}' AS INTEGER) AS \"r_name_{r}\"" for r in P.REGIONS]
    return f"WITH {CUSTOMERS} SELECT id, {', '.join(segments + regions)} FROM customers"


def one_hot_long() -> str:
    segments = ", ".join(quoted(s) for s in P.SEGMENTS)
    return f"""WITH {CUSTOMERS}
SELECT id, 'c_mktsegment_' || segment AS feature FROM customers WHERE segment IN ({segments})
UNION ALL SELECT id, 'r_name_' || r_name FROM customers"""


def category_distribution() -> str:
    long = " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS value FROM companies" for f in SIX)
    return f"""WITH {COMPANIES}, long AS ({long}),
counts AS (SELECT field, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY field, value)
SELECT field, value, n, round(n / sum(n) OVER (PARTITION BY field), 8) AS share FROM counts"""


def sentiment() -> str:
    return f"""WITH {pairs("lexicon", P.POLARITY)},
tok AS (SELECT source, unnest({words("text")}) AS term FROM documents),
scored AS (SELECT source, coalesce(replacement, 0) AS p FROM tok LEFT JOIN lexicon USING (term))
SELECT source AS "group", round(avg(CAST(p > 0 AS DOUBLE)), 8) AS positive, round(avg(CAST(p = 0 AS DOUBLE)), 8) AS neutral,
  round(avg(CAST(p < 0 AS DOUBLE)), 8) AS negative,
  CASE WHEN sum(p) > 0 THEN 'positive' WHEN sum(p) < 0 THEN 'negative' ELSE 'neutral' END AS sentiment
FROM scored GROUP BY source"""


def score_display() -> str:
    return f"""WITH found AS ({search("B").replace("round(sim, 6)", "sim")})
SELECT request_id, rank, id, lang, source, printf('%.4f', similarity) AS score_text, printf('%.3f', similarity) AS short_text,
  round(greatest(0.0, least(1.0, similarity)), 6) AS clipped FROM found JOIN documents ON doc_id = id"""


def idf(formula: str) -> str:
    return f"""WITH {RAW_DOCS}, {weights("dtok", formula)}
SELECT term, df, round(idf, 8) AS idf FROM vocab WHERE idf > 1e-12"""


def tfidf(formula: str, max_terms: int | None = None) -> str:
    return f"WITH {RAW_DOCS}, {weights('dtok', formula, max_terms)} SELECT id, term, round(w, 6) AS w FROM weights"


def top(k: int) -> str:
    return f"WITH {RAW_DOCS} SELECT term, count(*) AS n FROM dtok GROUP BY term ORDER BY n DESC, term LIMIT {k}"


ORACLES: dict[str, str] = {
    "clean_text": f"SELECT doc_id AS id, {clean('text')} AS cleaned FROM documents",
    "is_english": f"WITH {ALL_TEXTS}, c AS (SELECT kind, id, {clean('text')} AS c FROM all_texts) "
    f"SELECT kind, id, {english('c')} AS english FROM c",
    "normalize_text": f"WITH {MAPS}, {ALL_TEXTS}, base AS (SELECT kind || '-' || id AS k, text FROM all_texts), "
    f"{normalized('base')} SELECT kind, id, normalized FROM all_texts JOIN norm ON k = kind || '-' || id",
    "tokens_ws": f"WITH t AS (SELECT doc_id AS id, {ws(clean('text'))} AS t FROM documents) "
    "SELECT id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, '|') AS tokens FROM t",
    "tokens_word": f"WITH t AS (SELECT doc_id AS id, {words('text')} AS t FROM documents) "
    "SELECT id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, '|') AS tokens FROM t",
    "combined_text": "SELECT conv_id, turn, concat_ws(' ', role, CASE WHEN role <> 'system' THEN text END) AS combined, "
    f"regexp_replace(regexp_replace(text, '[a-zA-Z]', '', 'g'), '{WHITESPACE}', '', 'g') = '' AS blank FROM conversations",
    "term_counts": f"WITH {RAW_DOCS} SELECT id, term, count(*) AS tf FROM dtok GROUP BY id, term",
    "term_frequency_top": top(100),
    "vocab_top500": top(500),
    "idf_log2": idf("log2"),
    "idf_smooth": idf("smooth"),
    "tfidf_weights_a": tfidf("log2"),
    "tfidf_weights_b": tfidf("smooth"),
    "tfidf_weights_top500": tfidf("smooth", 500),
    "search_a": search("A"),
    "search_b": search("B"),
    "search_padded_a": search_padded("A"),
    "search_padded_b": search_padded("B"),
    "find_similar_a": find_similar("A"),
    "find_similar_b": find_similar("B"),
    "similar_profiles": similar_profiles("A"),
    "similar_profiles_b": similar_profiles("B"),
    "similar_profiles_b_blocks": similar_profiles("B"),
    "similar_pairs": similar_pairs(CUSTOMER_PROFILES, "log2", 4),
    "similar_pairs_text": pairs_text(),
    "recommend_retrieval": recommend(P.RETRIEVAL_THRESHOLD),
    "recommend_all": recommend(0.0),
    "unmatched_requests": f"{retrieve(P.STRICT_THRESHOLD)} "
    "SELECT rid AS request_id, cluster FROM req WHERE rid NOT IN (SELECT rid FROM best)",
    "mixed_requests": mixed_requests(),
    "one_hot_long": one_hot_long(),
    "one_hot_wide": one_hot_wide(),
    "category_distribution": category_distribution(),
    "cluster_distribution": "SELECT label AS cluster, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 8) AS share "
    "FROM embeddings GROUP BY label",
    "overview_metrics": "SELECT count(*) AS total_companies, count(DISTINCT label) AS n_clusters FROM embeddings",
    "category_values": "SELECT DISTINCT 'p_brand' AS field, p_brand AS value FROM part UNION ALL "
    "SELECT DISTINCT 'p_type', p_type FROM part UNION ALL SELECT DISTINCT 'p_size', CAST(p_size AS VARCHAR) FROM part",
    "name_to_id": "SELECT p_name AS name, max(p_partkey) AS id FROM part GROUP BY p_name",
    "sorted_names": "SELECT DISTINCT p_name AS name FROM part ORDER BY name",
    "route_requests": "SELECT conv_id * 1000 + turn AS request_id, CASE WHEN role <> 'system' THEN conv_id END AS company_id, "
    "CASE WHEN role = 'user' AND trim(text) <> '' THEN 'search' WHEN role <> 'system' THEN 'find' ELSE 'rejected' END AS route "
    "FROM conversations",
    "point_lookup": "SELECT d.doc_id AS id, quality, lang, source, n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id",
    "company_card": "SELECT s_suppkey AS id, s_name AS company_name, 'N/A' AS company_industry, 'N/A' AS company_size, "
    "n_name AS country, 'N/A' AS company_type, 'N/A' AS working_days, 'N/A' AS overtime_policy, 'N/A' AS location, "
    "'N/A' AS href, 'Balance ' || printf('%.2f', s_acctbal) AS company_overview "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "score_display": score_display(),
    "knn_classify": f"WITH {NEAREST}, {voted(5, 'v5')} SELECT id, label, prediction FROM v5",
    "knn_classify_pruned": f"WITH {NEAREST}, {voted(5, 'v5')} SELECT id, label, prediction FROM v5",
    "knn_accuracy": f"WITH {NEAREST}, {voted(5, 'v5')} "
    "SELECT round(avg(CAST(label = prediction AS DOUBLE)), 10) AS accuracy FROM v5",
    "model_report": f"{FAMILY} SELECT family, model, round(accuracy, 10) AS accuracy, "
    "round(accuracy * 100, 8) AS accuracy_pct FROM results",
    "best_of_report": f"{FAMILY} SELECT model AS best_model, round(accuracy, 10) AS best_accuracy, "
    "printf('%.2f', accuracy * 100) || '%' AS best_accuracy_text FROM results ORDER BY accuracy DESC, model LIMIT 1",
    "centroids": "WITH e AS (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS p "
    "FROM embeddings) SELECT label, CAST(p - 1 AS INTEGER) AS pos, round(avg(x), 6) AS mean FROM e GROUP BY label, p",
    "top2_clusters": "WITH data AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings), "
    + centroid("data", "centres")
    + ", r AS (SELECT id, c.label AS cluster, list_distance(v, c) AS distance, row_number() OVER (PARTITION BY id "
    "ORDER BY round(list_distance(v, c), 8), c.label) AS rank FROM data CROSS JOIN centres c) "
    "SELECT id, CAST(rank AS INTEGER) AS rank, cluster, round(distance, 6) AS distance FROM r WHERE rank <= 2",
    "sentiment_by_group": sentiment(),
}

# A trained model's digits are its own; how good it must be is told by a rate that SQL knows.
CLUSTERED = "e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings), " + centroid("e", "centres") + f""",
near AS (SELECT e.id, c.label, row_number() OVER (PARTITION BY e.id ORDER BY round(list_distance(v, c), 8), c.label) AS r
  FROM e CROSS JOIN centres c),
data AS (SELECT id, near.label, {TRAIN} AS train FROM near JOIN embeddings ON vec_id = id WHERE r = 1),
common AS (SELECT label AS l FROM data WHERE train GROUP BY label ORDER BY count(*) DESC, label LIMIT 1),
rates AS (SELECT round(avg(CAST(label = l AS DOUBLE)), 8) AS majority_rate FROM data, common WHERE NOT train)"""
for name in ("lr", "dt", "rf", "svm"):
    ORACLES[f"classify_{name}"] = f"""WITH {CLUSTERED} SELECT id, label, true AS known_label, majority_rate,
  true AS beats_majority FROM data, rates WHERE NOT train"""
ORACLES["best_model"] = f"""WITH {CLUSTERED} SELECT 5 AS models, true AS best_is_greatest, majority_rate,
  true AS beats_majority FROM rates"""
# Gaussian naive Bayes: log prior plus log densities; variances are smoothed by 1e-9 of the greatest one.
ORACLES["classify_nb"] = f"""WITH {SPLIT},
long AS (SELECT id, label, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM train),
smooth AS (SELECT 1e-9 * max(s) AS e FROM (SELECT var_pop(x) AS s FROM long GROUP BY j)),
fitted AS (SELECT label, j, avg(x) AS m, var_pop(x) + (SELECT e FROM smooth) AS s FROM long GROUP BY label, j),
prior AS (SELECT label, ln(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM train)) AS p FROM train GROUP BY label),
asked AS (SELECT id, label AS truth, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM test),
scored AS (SELECT id, truth, f.label, sum(-0.5 * ln(2 * pi() * s) - (x - m) * (x - m) / (2 * s)) AS l
  FROM asked JOIN fitted f ON asked.j = f.j GROUP BY id, truth, f.label),
ranked AS (SELECT id, truth, label, row_number() OVER (PARTITION BY id ORDER BY l + p DESC) AS r
  FROM scored JOIN prior USING (label))
SELECT id, truth AS label, CAST(label AS DOUBLE) AS prediction FROM ranked WHERE r = 1"""
ORACLES["pca_project"] = """WITH long AS (
  SELECT unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS j FROM embeddings)
SELECT max(n) AS rows, round(sum(s), 6) AS total_variance, 0 AS correlated_pairs
FROM (SELECT var_pop(x) AS s, count(*) AS n FROM long GROUP BY j)"""
ORACLES["kmeans_cluster"] = "SELECT count(*) AS points, true AS clusters_in_range, 0 AS nearer_elsewhere FROM embeddings"
ORACLES["word2vec_similar"] = """SELECT doc_id AS request_id, 5 AS results, true AS dense, true AS falling,
  true AS in_range, true AS without_itself FROM labels"""
ORACLES["recommender_saved"] = """SELECT count(*) AS companies, 2 AS models, true AS chosen_is_good, true AS has_rows,
  0 AS differing_rows, 0 AS rows_outside_cluster FROM documents"""
ORACLES["recommend_full"] = """SELECT 0 AS bad_ranks, 0 AS bad_requests, 0 AS bad_clusters, 0 AS bad_scores,
  true AS has_rows"""

ORACLES["term_map_file"] = """SELECT p_name || '-' || p_partkey AS term, p_brand || chr(9) || p_type AS replacement
FROM part"""
ORACLES["term_map_file_trimmed"] = "SELECT p_name || '-' || p_partkey AS term, p_brand AS replacement FROM part"
ORACLES["word_list_file"] = "SELECT DISTINCT p_name AS term FROM part"
ORACLES["companies_csv"] = ORACLES["companies_parquet"] = """SELECT c_custkey AS id, c_name AS company_name,
  c_mktsegment || chr(10) || '"quoted", second line' AS company_overview, c_mktsegment AS company_type FROM customer"""
ORACLES["model_report_files"] = f"""{FAMILY}, best AS (SELECT model, accuracy FROM results ORDER BY accuracy DESC, model LIMIT 1)
SELECT CASE family WHEN 'neighbours' THEN 'sklearn' ELSE 'pyspark' END AS family, results.model,
  round(results.accuracy, 8) AS accuracy, best.model AS recorded_best,
  printf('%.2f', best.accuracy * 100) || '%' AS best_accuracy_text
FROM results CROSS JOIN best"""

# The second way of a job has the SQL of the first.
for second, first in {
    "normalize_text_join": "normalize_text",
    "tfidf_weights_a_split": "tfidf_weights_a",
    "search_a_blocks": "search_a",
    "search_b_blocks": "search_b",
    "search_a_loaded": "search_a",
    "search_a_in_job": "search_a",
    "find_similar_a_bounded": "find_similar_a",
    "find_similar_b_bounded": "find_similar_b",
    "find_similar_a_broadcast": "find_similar_a",
    "search_a_by_term": "search_a",
    "search_b_by_term": "search_b",
    "search_padded_a_by_term": "search_padded_a",
    "written_results": "point_lookup",
    "similar_pairs_prefixes": "similar_pairs",
    "similar_pairs_grid": "similar_pairs",
    "similar_pairs_text_grid": "similar_pairs_text",
    "mixed_requests_broadcast": "mixed_requests",
    "recommend_retrieval_blocks": "recommend_retrieval",
    "recommend_all_blocks": "recommend_all",
}.items():
    ORACLES[second] = ORACLES[first]
