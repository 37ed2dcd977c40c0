"""The registered queries in SQL, where SQL can express them."""

from __future__ import annotations

from starpipe.llm.chat import ESCAPE, Template
from starpipe.llm.common import UPPER
from starpipe.llm.fim import RATE, SENTINELS, SPM
from starpipe.llm.phrases import LEAST, MOST_WORDS, NO_LANG, TOP
from starpipe.llm.phrases import PERCENT as ACCOUNTS
from starpipe.llm.setjoin import PERCENT, WORDS
from starpipe.llm.url_filter import BLOCK, RULES, THRESHOLD, VOCABULARY
from starpipe.llm.vectors import COSINE


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _lower(column: str) -> str:
    return f"translate({column}, '{UPPER}', '{UPPER.lower()}')"


def url_filters(rules=RULES, vocabulary=VOCABULARY) -> str:
    fitting = []
    for rule, verdict in rules.items():
        at, _, start = rule.partition("/")
        fitting.append(
            f"SELECT '{rule}' AS rule, '{verdict}' AS verdict, '{at}' AS at, '/{start}' AS start"
        )
    url = _lower("coalesce(url, '')")
    terms = " + ".join(
        f"CASE WHEN regexp_matches({url}, '(^|[^a-z0-9]){term}($|[^a-z0-9])') THEN {weight} ELSE 0 END"
        for term, weight in vocabulary.items()
    )
    host = _lower("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')")
    return f"""
WITH rules AS ({" UNION ALL ".join(fitting)}),
parts AS (
  SELECT page_id, {host} AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
    CAST({terms} AS BIGINT) AS term_weight
  FROM pages
),
best AS (
  SELECT p.*, (SELECT max_by(r.rule, length(r.rule)) FROM rules r
    WHERE (p.host = r.at OR ends_with(p.host, '.' || r.at)) AND starts_with(p.path, r.start)) AS rule
  FROM parts p
)
SELECT b.page_id, b.host, b.path, b.rule, b.term_weight,
  coalesce(r.verdict, CASE WHEN b.term_weight >= {THRESHOLD} THEN '{BLOCK}' ELSE 'allow' END) AS verdict
FROM best b LEFT JOIN rules r ON r.rule = b.rule
"""


def chat(said: str, template: Template = Template()) -> str:
    def escaped(column: str) -> str:
        done = f"replace({column}, '{ESCAPE}', '{ESCAPE}e')"
        for word in sorted({*template.control, template.begin, template.end}):
            done = f"replace({done}, {_text(word)}, {_text(word[0] + ESCAPE + 'c' + word[1:])})"
        return done

    marks = len(template.begin) + len(template.end) + 2
    role = f"replace({escaped('role')}, chr(10), '{ESCAPE}n')"
    learnt = "FILTER (role = 'assistant')"
    order = "ORDER BY turn, role, text"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {_text(said)} UNION ALL SELECT -1, 1, 'assistant', {_text(said)}
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
  CAST(coalesce(sum(length(text)) {learnt}, 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' {order}) {learnt}, '')) AS loss_sha256,
  CAST(sum({marks} + length({role}) + length({escaped("text")})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


def set_join() -> str:
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
grams AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE [list_aggregate(w[i:i + {WORDS - 1}], 'string_agg', ' ') FOR i IN range(1, len(w) - {WORDS - 2})] END) AS g
  FROM words
),
entries AS (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM grams),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM entries a JOIN entries b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))
),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node
)
SELECT g.doc_id, len(g.g) AS n_shingles, min(r.root) AS component_id
FROM grams g JOIN reach r ON r.node = g.doc_id GROUP BY g.doc_id, g.g
"""


def vectors() -> str:
    return f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}
),
reach AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node
),
roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
linked AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(l.n, 0) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN roots r ON r.node = e.vec_id LEFT JOIN linked l ON l.a = e.vec_id
"""


def duplicates() -> str:
    return """
WITH whole AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM whole WINDOW same AS (PARTITION BY text)
"""


def fill_in_middle() -> str:
    return f"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w
  FROM documents
),
numbers AS (
  SELECT *, len(w) AS n, [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) FOR i IN range(4)] AS x FROM drawn
),
cuts AS (
  SELECT *, least(x[1] % (n + 1), x[2] % (n + 1)) AS one, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS two,
    CASE WHEN text = '' OR {" OR ".join(f"contains(text, '{s}')" for s in SENTINELS)} OR x[3] % 100 >= {RATE}
      THEN 'plain' WHEN x[4] % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
),
parts AS (
  SELECT *, array_to_string(w[1:one], '') AS prefix, array_to_string(w[one + 1:two], '') AS middle,
    array_to_string(w[two + 1:n], '') AS suffix
  FROM cuts
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


def phrases() -> str:
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang,
    unnest(string_split_regex({_lower("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
  FROM words, range(1, {MOST_WORDS + 1}) AS sizes(m)
),
f AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
inside AS (
  SELECT c.lang, c.phrase FROM f c JOIN f d ON c.lang = d.lang AND c.m < d.m AND c.m > 1
    AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * d.a >= {ACCOUNTS} * c.a
),
cuts AS (
  SELECT lang, phrase, a, k, string_split(phrase, ' ') AS w, m
  FROM f, range(1, {MOST_WORDS}) AS ks(k) WHERE k < m
),
scores AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, n,
    CAST((1000 * CAST(c.a AS HUGEINT) * n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:c.m], ' ')
  WHERE (c.lang, c.phrase) NOT IN (SELECT (lang, phrase) FROM inside)
),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= {TOP}
"""
