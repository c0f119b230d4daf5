"""The registered queries in DuckDB SQL, over the same tables.

Written from the meaning of each operator, independently of the Spark plans.
"""

from __future__ import annotations

from gazette import constants as C

AS_OF = "TIMESTAMP '2024-01-31 01:00:00'"

# White space as RE2 writes it; \s is ASCII there.
WS = (
    r" \t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}"
)
ENTITIES = [
    ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"),
    ("&nbsp;", "chr(160)"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&amp;", "'&'"),
]
TAG = r"</?[a-z][^>]*>|<[!?][^>]*>"
PARAGRAPH = r"(?is)<p(?:\s[^>]*)?>"


def element(name):
    return rf"<{name}\b[^>]*>.*?</{name}\s*>"


def norm(x):
    return f"trim(regexp_replace(coalesce({x}, ''), '[{WS}]+', ' ', 'g'))"


def strip(x):
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def decode(x):
    for entity, char in ENTITIES:
        x = f"replace({x}, '{entity}', {char})"
    return x


def boilerplate(x):
    parts = "|".join(["<!--.*?-->"] + [element(e) for e in ("script", "style", "noscript")])
    return f"regexp_replace({x}, '(?is){parts}', '', 'g')"


def visible(x):
    unseen = ["<!--.*?-->"] + [element(e) for e in ("script", "style", "template", "rt", "rp")]
    marked = f"regexp_replace({x}, '(?is){'|'.join(unseen)}|{TAG}', chr(1), 'g')"
    spaced = f"regexp_replace({decode(marked)}, '[{WS}]*\\x01[{WS}\\x01]*', ' ', 'g')"
    return strip(spaced)


def page_text(x):
    return norm(visible(f"coalesce({x}, '')"))


def any_of(x, words):
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def count_of(x, words):
    return "(" + " + ".join(f"contains({x}, '{w}')::int" for w in words) + ")"


def theme(x):
    branches = " ".join(f"WHEN {any_of(x, words)} THEN '{t}'" for t, words in C.THEMES.items())
    return f"CASE {branches} ELSE '{C.OTHER_THEME}' END"


def iso(ts):
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"


def host(x):
    return f"lower(regexp_extract({x}, '(?i)^https?://([^/?#]*)', 1))"


# The shapes of an IPv6 address, by the number of groups on each side of "::"
_H = "[0-9a-f]{1,4}"
IPV6 = "|".join(
    [f"({_H}:){{7}}{_H}", f"({_H}:){{1,7}}:", f":(:{_H}){{1,7}}", "::"]
    + [f"({_H}:){{1,{n}}}(:{_H}){{1,{7 - n}}}" for n in range(1, 7)]
)


def broken(x):
    """Brackets in a lower-case host that hold no address."""
    sound = rf"([^\[\]]*@)?\[(({IPV6})(%[^%\[\]]+)?|v[0-9a-f]+\.[^\[\]]+)\](:[^\[\]]*)?"
    return f"(regexp_matches({x}, '[\\[\\]]') AND NOT regexp_full_match({x}, '{sound}'))"


def path(x):
    whole = f"regexp_extract({x}, '(?i)^https?://[^/?#]*([^?#]*)', 1)"
    return f"lower(regexp_replace({whole}, ';[^/]*$', ''))"


def keywords_of(x):
    return rf"unnest(regexp_extract_all(lower(coalesce({x}, '')), '[a-z]{{4,}}'))"


def stop(words):
    return ", ".join(f"'{w}'" for w in words)


def tag_of(page, tag, attribute, value):
    pattern = rf"(?is)<{tag}\b[^>]*?\b{attribute}\s*=\s*[\"'']{value}[\"''][^>]*>"
    return f"regexp_extract({page}, '{pattern}')"


def attribute_of(tag, name):
    quoted = rf"regexp_extract({tag}, '(?is)\b{name}\s*=\s*(\"[^\"]*\"|''[^'']*'')', 1)"
    return decode(f"substr({quoted}, 2, greatest(length({quoted}) - 2, 0))")


def meta(page, key):
    by_property, by_name = tag_of(page, "meta", "property", key), tag_of(page, "meta", "name", key)
    return attribute_of(
        f"CASE WHEN {by_property} <> '' THEN {by_property} ELSE {by_name} END", "content"
    )


def clean_title(x):
    return f"regexp_replace({norm(x)}, ' [-|—] .*$', '')"


# Inputs: CTE name -> SQL, in order of dependency.

SCORE = "((content_length > 100)::int + (word_count > 20)::int + (title IS NOT NULL)::int) / 3.0"
_reasons = f"""
CASE WHEN u = '' THEN ['url_missing']
     WHEN NOT (starts_with(u, 'http://') OR starts_with(u, 'https://')) THEN ['url_invalid_scheme']
     WHEN {broken(host('u'))} THEN ['url_parse_error']
     ELSE list_filter([
       CASE WHEN t = '' THEN 'title_missing' WHEN length(t) < 8 THEN 'title_too_short' END,
       CASE WHEN t <> '' AND {any_of('lower(t)', C.GENERIC_TITLE_WORDS)} THEN 'title_generic' END,
       CASE WHEN length(t) > 5
             AND length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) / length(t) > 0.8
            THEN 'title_all_caps' END,
       CASE WHEN t <> '' AND length(regexp_replace(t, '[^!?.,:;-]', '', 'g')) / length(t) > 0.3
            THEN 'title_overpunctuated' END,
       CASE WHEN c <> '' AND length(c) < 80 AND length(t) < 25 THEN 'content_sparse' END,
       CASE WHEN contains(s, 'bbc') THEN CASE WHEN NOT contains(h, 'bbc.com')
                                              THEN 'url_domain_mismatch' END
            WHEN contains(s, 'hespress') THEN CASE WHEN NOT contains(h, 'hespress')
                                                   THEN 'url_domain_mismatch' END
            WHEN contains(s, 'reuters') THEN CASE WHEN NOT contains(h, 'reuters.com')
                                                  THEN 'url_domain_mismatch' END END,
       CASE WHEN p = '' THEN NULL
            WHEN contains(s, 'bbc') THEN CASE WHEN NOT starts_with(p, '/news/')
                                              THEN 'url_path_unexpected' END
            WHEN contains(s, 'hespress') THEN CASE WHEN NOT ends_with(p, '.html')
                                                   THEN 'url_path_unexpected' END
            WHEN contains(s, 'reuters') THEN CASE WHEN NOT {any_of('p', C.REUTERS_SECTIONS)}
                                                  THEN 'url_path_unexpected' END END
     ], lambda r: r IS NOT NULL) END"""

# Average of the stored scores, rounded half up in whole hundredths
_HUNDREDTHS = "sum((data_quality_score::DECIMAL(3,2) * 100)::BIGINT)"
AVG_SCORE = f"((2 * {_HUNDREDTHS} + count(*)) // (2 * count(*)) / 100.0)::DECIMAL(3,2)"

INPUTS = {
    "sources": "SELECT * FROM (VALUES "
    + ", ".join(f"('{n}', '{c}')" for n, c, _ in C.SOURCES)
    + ") v(name, country)",
    "heads": r"SELECT *, doc_id AS k, regexp_extract(text, '^[^.!?\n]*') AS headline "
    "FROM documents",
    "articles": """
SELECT *, substr(sha256(coalesce(url, 'doc' || doc_id)), 1, 24) AS article_id FROM (
SELECT doc_id, lang,
  CASE WHEN k%17=1 THEN NULL WHEN k%23=2 THEN '' WHEN k%29=3 THEN 'Read more'
       WHEN k%19=4 THEN upper(replace(headline, 'ß', 'ss')) WHEN k%31=5 THEN '?!?!--..ab'
       WHEN k%37=6 THEN 'Short' ELSE headline END AS title,
  CASE WHEN k%9=0 THEN NULL WHEN k%10=1 THEN 'Unknown' ELSE 'author' || (k%40) END AS author,
  CASE WHEN k%37=11 THEN NULL
       WHEN k%47=12 THEN TIMESTAMP '2024-03-01' + to_minutes(k%60)
       ELSE TIMESTAMP '2024-01-01' + to_minutes((k*43)%43200) END AS published_at,
  CASE WHEN k%7<>0 THEN lang END AS category,
  '<html><body>' || chr(10) || '<p>'
    || replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),
               chr(10), '</p>' || chr(10) || '<p>')
    || '</p>' || chr(10) || '</body></html>' AS content_html,
  CASE WHEN k%41=10 THEN NULL WHEN k%43=9 THEN '' ELSE text END AS content,
  CASE WHEN k%61=15 THEN NULL WHEN k%5=0 THEN 'BBC News' WHEN k%5=1 THEN 'Reuters World'
       WHEN k%5=2 THEN 'Hespress' WHEN k%5=3 THEN 'France24' ELSE source END AS source,
  CASE WHEN k%13=7 THEN NULL
       WHEN k%11=8 THEN 'ftp://files.example.com/' || k
       WHEN k%5=0 AND k%2=0 THEN 'https://www.bbc.com/news/' || (k//50)
       WHEN k%5=1 AND k%2=0 THEN 'https://www.reuters.com/world/' || (k//50)
       WHEN k%5=2 AND k%2=0 THEN 'https://fr.hespress.com/' || (k//50) || '.html'
       ELSE 'https://news.example.org/' || lang || '/' || (k//4) END AS url,
  CASE WHEN k%53=14 THEN 'http://[::1/x'
       WHEN k%59=16 THEN 'https://www.bbc.com/sport;v=1'
       WHEN k%71=17 THEN 'http://[::1]/x' WHEN k%73=18 THEN 'http://[::g]/x'
       WHEN k%79=19 THEN 'http://a[b]/x' WHEN k%83=20 THEN 'http://[2001:db8::7%eth0]:80/x'
       WHEN k%89=21 THEN 'http://[1:2:3:4:5:6:7:8:9]/x' END AS canonical_url,
  CASE WHEN k%97<>50 THEN TIMESTAMP '2024-01-30 22:00:00' + to_minutes((k*7)%180) END AS scraped_at
FROM heads)""",
    "judged": f"""
SELECT *, array_to_string(reasons, ';')[1:200] AS reason, len(reasons) > 0 AS quarantine FROM (
SELECT *, {_reasons} AS reasons FROM (
SELECT *, {host('u')} AS h, {path('u')} AS p FROM (
SELECT *, {strip("coalesce(title, '')")} AS t, {strip("coalesce(content, '')")} AS c,
  lower(coalesce(source, '')) AS s,
  coalesce(nullif({strip("coalesce(canonical_url, '')")}, ''), {strip("coalesce(url, '')")}) AS u
FROM articles)))""",
    "detail": """
SELECT *, scraped_at - to_days((doc_id%20)::int) AS ingested_at,
  TIMESTAMP '2024-01-01' AS created_at FROM judged""",
    "existing": """
SELECT * EXCLUDE (quarantine, rn), doc_id%2=0 AS quarantine FROM (
  SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY doc_id) AS rn FROM detail
  WHERE NOT coalesce(scraped_at > TIMESTAMP '2024-01-31', false)) WHERE rn = 1""",
    "incoming": """
SELECT * EXCLUDE (ingested_at, rn), scraped_at AS ingested_at FROM (
  SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY doc_id) AS rn FROM detail
  WHERE scraped_at > TIMESTAMP '2024-01-31') WHERE rn = 1""",
    "audit": """
SELECT article_id, 'mark' AS action, 'system' AS performed_by,
  CASE WHEN doc_id%4=0 THEN 'retroactive-backfill' ELSE 'title_missing' END AS reason,
  TIMESTAMP '2024-01-30' AS performed_at FROM existing WHERE quarantine
UNION ALL
SELECT substr(sha256('doc' || doc_id), 1, 24), 'mark', 'system', 'title_generic',
  TIMESTAMP '2024-01-30' FROM labels WHERE toxic = 1""",
    "batch": f"""
SELECT a.article_id, a.title, a.author,
  CASE WHEN doc_id%67=20 THEN 'not a date' ELSE {iso('a.published_at')} END AS published_at,
  a.category, a.content_html, a.content, a.source,
  coalesce(country, 'Unknown') AS source_country, a.url, a.canonical_url,
  {iso('a.scraped_at')} AS scraped_at, 'batch' AS ingestion_mode,
  {iso(AS_OF)} AS ingested_at
FROM articles a LEFT JOIN sources ON a.source = name""",
    "bronze": """
SELECT *, NULL::VARCHAR AS stream_received_at FROM batch
UNION ALL
SELECT * REPLACE ('streaming' AS ingestion_mode), scraped_at FROM batch
WHERE scraped_at > '2024-01-31T00:00:00.000000+00:00'""",
    "latest": """
SELECT * EXCLUDE rn FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY scraped_at DESC NULLS FIRST,
    ingestion_mode DESC NULLS LAST, article_id NULLS LAST, published_at NULLS LAST,
    title NULLS LAST, content NULLS LAST) AS rn FROM bronze) WHERE rn = 1""",
    "lake": f"""
SELECT *, coalesce(nullif(content_clean, ''), {norm('content_from_html')}) AS content_final FROM (
SELECT * REPLACE (
    {norm('title')} AS title,
    {norm("coalesce(author, 'Unknown')")} AS author,
    {norm("coalesce(category, 'Unknown')")} AS category,
    {norm("coalesce(source, 'Unknown')")} AS source,
    try_strptime(published_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS published_at),
  {norm('content')} AS content_clean,
  {visible("coalesce(content_html, '')")} AS content_from_html
FROM latest)""",
    "texted": f"""
SELECT *, {norm('content_text')} AS content_clean FROM (
SELECT *, {visible("coalesce(content, '')")} AS content_text FROM detail)""",
    "measured": f"""
SELECT * EXCLUDE (content_text, fr, en),
  CASE WHEN content_clean = '' THEN 'unknown' WHEN fr > en THEN 'fr' WHEN en > fr THEN 'en'
       ELSE 'mixed' END AS detected_language,
  {SCORE} AS data_quality_score FROM (
SELECT *, length(content_clean) AS content_length,
  len(regexp_extract_all(content_clean, '[^ ]+')) AS word_count,
  regexp_replace({norm('title')}, '[^\\p{{L}}\\p{{N}}_{WS}\\-.,!?]', '', 'g') AS title_normalized,
  {count_of('lower(content_clean)', C.FRENCH_INDICATORS)} AS fr,
  {count_of('lower(content_clean)', C.ENGLISH_INDICATORS)} AS en
FROM texted)""",
    "entries": """
SELECT page_id,
  CASE WHEN slot <= 1 THEN 'BBC News' WHEN slot = 2 THEN 'Reuters World'
       WHEN slot = 3 THEN 'Hespress' WHEN slot = 4 THEN 'France24' ELSE 'Local Post' END AS source,
  CASE WHEN slot <= 3 THEN 'International' WHEN slot = 4 THEN 'France' ELSE 'Unknown' END
    AS source_country,
  greatest(slot - 1, 0)::int AS source_pos, page_id AS feed_pos,
  CASE WHEN k%11=5 THEN '' ELSE url END AS url,
  replace(html, '<head>', '<head>' || CASE
    WHEN k%5=0 THEN '<link rel="canonical" href="' || site || '/home">'
    WHEN k%5=1 THEN '<link href="' || site || '" rel="canonical"><meta property="og:url" content="'
      || bare || '"><meta property="og:title" content="' || name || ' - The Site | World">'
    WHEN k%5=2 THEN '<meta content="' || bare || '" name="og:url">'
      || '<meta content="Sport live" name="og:title">'
      || '<noscript><p>Please switch on scripts to read the whole story</p></noscript>'
    WHEN k%5=3 THEN '<meta property="og:title" content="">' ELSE '' END) AS html,
  CASE WHEN k%9<>1 THEN 'Feed story ' || k || ' — Feed' END AS title,
  CASE WHEN k%4<>0 THEN 'author' || (k%40) END AS author,
  CASE WHEN k%7=0 THEN CASE WHEN k%2=0 THEN ts END
       WHEN k%7=2 THEN ts - INTERVAL 2 HOUR
       WHEN k%7=3 THEN NULL ELSE ts END AS published_ts,
  CASE WHEN k%8<>2 THEN regexp_extract(url, '/([a-z]{2})/', 1) ELSE 'Unknown' END AS category
FROM (SELECT *, page_id AS k, page_id%6 AS slot,
  regexp_extract(url, '^(https?://[^/]+)', 1) AS site, regexp_extract(url, '^([^?#]*)', 1) AS bare,
  regexp_extract(html, '<title>([^<]*)</title>', 1) AS name,
  TIMESTAMP '2024-01-01 10:00:00' + to_minutes(page_id) AS ts FROM pages)""",
    "cleaned": f"SELECT * REPLACE ({boilerplate('html')} AS html) FROM entries",
}

_title_tag = decode(r"regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1)")
_menu = any_of("lower(x)", C.TITLE_BLACKLIST)
_usable = (
    f"length(x) >= 8 AND lower(x) NOT IN ({stop(C.TITLE_BLACKLIST)}) "
    f"AND NOT (len(string_split(x, ' ')) <= 2 AND {_menu}) "
    "AND regexp_matches(x, '[a-zA-ZÀ-ÿ]')"
)
INPUTS["parsed"] = f"""
SELECT * EXCLUDE (candidates, paras),
  coalesce(list_filter(list_transform(list_filter(candidates, lambda x: x IS NOT NULL),
      lambda x: {clean_title('x')}), lambda x: {_usable})[1], {clean_title('title')}) AS best_title,
  array_to_string(list_filter(list_transform(paras, lambda x:
      {norm(decode(f"regexp_replace(x, '(?is){TAG}', ' ', 'g')"))}),
      lambda x: length(x) > 30)[1:30], chr(10)) AS content,
  array_to_string(list_transform(
      list_zip(regexp_extract_all(html, '{PARAGRAPH}'), paras)[1:30],
      lambda z: z[1] || z[2] || '</p>'), chr(10)) AS content_html,
  substr(sha256(coalesce(nullif(canonical_url, ''), url)), 1, 24) AS article_id
FROM (SELECT *, [nullif({meta('html', 'og:title')}, ''), {_title_tag}, title] AS candidates,
  list_transform(string_split_regex(html, '{PARAGRAPH}')[2:], lambda x: string_split_regex(x,
      '(?is)</p>|</article>|</section>|</div>|</body>')[1]) AS paras,
  coalesce(nullif({meta('html', 'og:url')}, ''),
      {attribute_of(tag_of('html', 'link', 'rel', 'canonical'), 'href')}) AS canonical_url
FROM cleaned)"""

NEEDS = {
    "articles": ["heads"], "judged": ["articles"], "detail": ["judged"], "existing": ["detail"],
    "incoming": ["detail"], "audit": ["existing"], "batch": ["articles", "sources"],
    "bronze": ["batch"], "latest": ["bronze"], "lake": ["latest"], "texted": ["detail"],
    "measured": ["texted"], "cleaned": ["entries"], "parsed": ["cleaned"],
}


def sql(body: str, *inputs: str) -> str:
    """The query with the inputs it needs, and theirs, put in front."""
    ordered: list[str] = []

    def add(name):
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in inputs:
        add(name)
    if not ordered:
        return body
    # materialised where several reads would otherwise expand the same regexes
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({INPUTS[n].strip()})" for n in ordered)
    return f"WITH {ctes}\n{body.strip()}"


DETAIL_COLUMNS = (
    "article_id, title, author, source, published_at, url, canonical_url, content, category, "
    "ingested_at, quarantine, created_at"
)
BRONZE_COLUMNS = (
    "article_id, title, author, published_at, category, content_html, content, source, "
    "source_country, url, canonical_url, scraped_at"
)


def count_by(key, table):
    return f"SELECT {key}, count(*) AS articles_count FROM {table} GROUP BY 1"


DAY = "published_at::DATE AS published_day"
BY_SOURCE = count_by("source", "detail")
BY_COUNTRY = (
    "SELECT coalesce(country, 'Unknown') AS source_country, count(*) AS articles_count "
    "FROM detail LEFT JOIN sources ON source = name GROUP BY 1"
)
LAKE_THEME = theme("lower(title || ' ' || content_final)")
DETAIL_THEME = theme("lower(coalesce(title, '') || ' ' || coalesce(content, ''))")


def keywords(column, table, words, n):
    return f"""SELECT keyword, count(*) AS frequency
FROM (SELECT {keywords_of(column)} AS keyword FROM {table})
WHERE keyword NOT IN ({stop(words)}) GROUP BY 1 ORDER BY frequency DESC, keyword LIMIT {n}"""


LAKE_KEYWORDS = keywords("content_final", "lake", C.STOPWORDS, 25)
TITLE_KEYWORDS = keywords("title", "detail", C.WAREHOUSE_STOPWORDS, 100)


def long_form(parts):
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, key::VARCHAR AS key, n FROM ({q}) v(key, n)"
        for t, q in parts.items()
    )


RECENT = """
SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY source
  ORDER BY published_at DESC NULLS FIRST, article_id) AS rn FROM {}) WHERE rn <= 10"""
PREV = "(SELECT article_id AS id, quarantine AS was, created_at AS born FROM existing)"
UPSERTED = f"""
SELECT {DETAIL_COLUMNS} FROM existing
WHERE article_id NOT IN (SELECT article_id FROM incoming)
UNION ALL
SELECT {DETAIL_COLUMNS.replace('created_at', f'coalesce(born, {AS_OF}) AS created_at')}
FROM incoming LEFT JOIN {PREV} ON article_id = id"""
INPUTS["upserted"] = UPSERTED
NEEDS["upserted"] = ["existing", "incoming"]
EXPIRED = f"coalesce(quarantine AND ingested_at < {AS_OF} - INTERVAL 7 DAY, false)"
_APPROVED = f"""quarantine AND article_id NOT IN (
  SELECT article_id FROM ({RECENT.format('upserted')}) WHERE quarantine) AS quarantine"""
CHECKS = f"""
SELECT 'articles_detail.title_null' AS name,
  (SELECT count(*) FROM upserted WHERE coalesce(title, '') = '') AS value
UNION ALL SELECT 'articles_detail.author_null',
  (SELECT count(*) FROM upserted WHERE author = 'Unknown')
UNION ALL SELECT 'articles_detail.content_null',
  (SELECT count(*) FROM upserted WHERE coalesce(content, '') = '')
UNION ALL SELECT 'orphaned_audit_records', (SELECT count(*) FROM audit q
  WHERE NOT EXISTS (SELECT 1 FROM upserted d WHERE d.article_id = q.article_id))
UNION ALL SELECT 'invalid_dates', (SELECT count(*) FROM upserted WHERE published_at > {AS_OF})
UNION ALL SELECT 'negative_lengths', (SELECT count(*) FROM measured WHERE content_length < 0)
UNION ALL SELECT 'invalid_scores', (SELECT count(*) FROM measured
  WHERE data_quality_score > 1 OR data_quality_score < 0)"""
CHECK_STATUS = f"""SELECT name, CASE WHEN value = 0 THEN 'PASS'
  WHEN name = 'orphaned_audit_records' THEN 'FAIL' ELSE 'WARN' END AS status, value
FROM ({CHECKS})"""

SILVER = """
SELECT m.article_id, m.title, m.title_normalized, m.author, m.content, m.content_clean,
  m.content_length::INTEGER AS content_length, m.word_count::INTEGER AS word_count, m.source,
  m.category, m.detected_language, m.published_at, m.url, m.canonical_url, false AS quarantine,
  m.data_quality_score::DECIMAL(3,2) AS data_quality_score, {} AS silver_timestamp,
  {} AS scraped_at
FROM measured m JOIN {} t ON m.doc_id = t.doc_id"""


def language_of(key, table, column):
    """Language per key by summed trigram scores of a profile of documents."""

    def grams(columns, source, x):
        return f"""SELECT {columns},
  unnest([((unicode(c[i]) * 7919 + unicode(c[i+1]) * 104729 + unicode(c[i+2]) * 1299709) % 262144)
    for i in range(1, len(c) - 1)]) AS gram
FROM (SELECT {columns}, string_split(' ' || lower({norm(x)}) || ' ', '') AS c FROM {source})"""

    return f"""
taught AS (SELECT lang, text FROM documents
  WHERE substr(md5(doc_id::VARCHAR), 1, 1) NOT IN ('0', '1', '2')),
frequent AS (SELECT lang, gram, count(*) AS n FROM ({grams('lang', 'taught', 'text')})
  GROUP BY 1, 2),
totals AS (SELECT lang, sum(n) AS total FROM frequent GROUP BY 1),
vocabulary AS (SELECT DISTINCT gram FROM frequent),
scores AS (SELECT v.gram, t.lang, round(ln((coalesce(f.n, 0) + 1)
    / (t.total + (SELECT count(*) FROM vocabulary))::DOUBLE) * 1000000)::BIGINT AS score
  FROM vocabulary v, totals t LEFT JOIN frequent f ON f.gram = v.gram AND f.lang = t.lang),
summed AS (SELECT key, lang, sum(score) AS score
  FROM ({grams('key', f'(SELECT {key} AS key, {column} FROM {table})', column)}) g
  JOIN scores s ON s.gram = g.gram GROUP BY 1, 2),
languages AS (SELECT key, arg_max(lang, (score, lang)) AS language FROM summed GROUP BY 1)"""


def with_languages(key, table, column, body, *inputs):
    ctes = language_of(key, table, column).strip()
    if not inputs:
        return f"WITH {ctes}\n{body}"
    start = sql("@", *inputs)
    return f"{start[:-2]},\n{ctes}\n{body}"


_event_text = """SELECT event_id, CASE event_id % 8
  WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
  WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+05:30')
  WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
  WHEN 3 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S +0200')
  WHEN 4 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S GMT')
  WHEN 5 THEN strftime(ts, '%-d %b %Y %H:%M:%S +0000')
  WHEN 6 THEN 'around ' || strftime(ts, '%a, %d %b %Y %H:%M:%S') END AS w FROM events"""

ORACLES = {
    "bronze_scan": sql(
        f"SELECT {BRONZE_COLUMNS}, ingestion_mode, ingested_at, stream_received_at FROM bronze",
        "bronze",
    ),
    "bronze_batch_sink": sql(
        f"""SELECT '2024-01-31' AS date, '01' AS hour, 'batch' AS ingestion_mode,
  {iso(AS_OF)} AS ingested_at, count(*) AS articles, count(DISTINCT article_id) AS ids
FROM batch""",
        "batch",
    ),
    "bronze_snapshot": sql(
        """SELECT '20240131_000000' AS run_ts, count(*) AS articles FROM batch
UNION ALL SELECT '20240131_010000', count(*) FROM batch WHERE url IS NOT NULL""",
        "batch",
    ),
    "article_to_json": sql(f"SELECT {BRONZE_COLUMNS}, ingestion_mode, ingested_at FROM batch",
                           "batch"),
    "gold_write": sql(
        long_form(
            {
                "articles_by_day": count_by("published_at::DATE", "lake"),
                "articles_by_source": count_by("source", "lake"),
                "articles_by_theme": count_by(LAKE_THEME, "lake"),
                "articles_by_country": count_by("source_country", "lake"),
                "top_keywords": LAKE_KEYWORDS,
            }
        ),
        "lake",
    ),
    "silver_snapshot": sql(
        f"""SELECT '20240131_010000' AS run_ts, article_id, title, author, content, source, category,
  published_at, url, canonical_url, coalesce(scraped_at, created_at) AS scraped_at, content_clean,
  title_normalized, content_length::INT AS content_length, word_count::INT AS word_count,
  detected_language, data_quality_score, {AS_OF} AS silver_timestamp FROM measured
WHERE coalesce(scraped_at, created_at) > {AS_OF} - INTERVAL 1 HOUR""",
        "measured",
    ),
    "gold_publish": sql(
        long_form(
            {
                "articles_by_day": count_by("published_at::DATE", "detail"),
                "articles_by_source": BY_SOURCE,
                "articles_by_theme": count_by(DETAIL_THEME, "detail"),
                "articles_by_country": BY_COUNTRY,
                "articles_by_category": count_by("category", "detail"),
                "top_keywords": TITLE_KEYWORDS,
            }
        ),
        "detail", "sources",
    ),
    "pages_clean_html": f"SELECT page_id, {boilerplate('html')} AS clean_html FROM pages",
    "pages_paragraphs": sql("SELECT page_id, content FROM parsed", "parsed"),
    "pages_paragraph_html": sql("SELECT page_id, content_html FROM parsed", "parsed"),
    "pages_canonical_url": sql("SELECT page_id, canonical_url FROM parsed", "parsed"),
    "pages_best_title": sql("SELECT page_id, best_title AS title FROM parsed", "parsed"),
    "article_identity": sql(
        """SELECT doc_id, substr(sha256(coalesce(nullif(canonical_url, ''), url)), 1, 24)
  AS identity FROM articles""",
        "articles",
    ),
    "normalize_published_at": f"""SELECT event_id, CASE event_id % 8
  WHEN 0 THEN try_strptime(w, '%Y-%m-%dT%H:%M:%SZ')
  WHEN 1 THEN try_strptime(w, '%Y-%m-%dT%H:%M:%S+05:30') - INTERVAL 330 MINUTE
  WHEN 2 THEN try_strptime(w, '%Y-%m-%d %H:%M:%S')
  WHEN 3 THEN try_strptime(w, '%a, %d %b %Y %H:%M:%S +0200') - INTERVAL 2 HOUR
  WHEN 4 THEN try_strptime(w, '%a, %d %b %Y %H:%M:%S GMT')
  WHEN 5 THEN try_strptime(w, '%d %b %Y %H:%M:%S +0000') END AS published_at
FROM ({_event_text})""",
    "first_category": sql("SELECT page_id, category FROM entries", "entries"),
    "first_n_per_source": sql(
        """SELECT source, feed_pos, url FROM (SELECT *, row_number() OVER (PARTITION BY source
  ORDER BY feed_pos) AS rn FROM entries) WHERE rn <= 25""",
        "entries",
    ),
    "dedup_keep_first": sql(
        """SELECT source, source_pos, feed_pos, article_id FROM (SELECT *, row_number() OVER (
  PARTITION BY article_id ORDER BY source_pos, feed_pos) AS rn FROM (SELECT * REPLACE (
    substr(sha256(coalesce(nullif(canonical_url, ''), url)), 1, 24) AS article_id)
    FROM (SELECT * REPLACE (CASE WHEN page_id%11=5 THEN '' ELSE url END AS url) FROM parsed)))
WHERE rn = 1""",
        "parsed",
    ),
    "extract_articles": sql(
        f"""SELECT article_id, best_title AS title, coalesce(author, 'Unknown') AS author,
  {iso('published_ts')} AS published_at, category, content_html, content, source, source_country,
  url, canonical_url, {iso(AS_OF)} AS scraped_at
FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY source_pos, feed_pos) AS rn
  FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY feed_pos) AS feed_rank
    FROM parsed) WHERE feed_rank <= 25 AND url <> '' AND best_title <> '') WHERE rn = 1""",
        "parsed",
    ),
    "silver_defaults": sql(
        f"""SELECT doc_id, {norm('title')} AS title,
  {norm("coalesce(author, 'Unknown')")} AS author,
  {norm("coalesce(category, 'Unknown')")} AS category,
  {norm("coalesce(source, 'Unknown')")} AS source FROM articles""",
        "articles",
    ),
    "normalize_text": f"""SELECT doc_id,
  {norm("replace(text, ', ', ',' || chr(160) || chr(8195) || chr(9))")} AS normalized
FROM documents""",
    "html_to_text": f"SELECT page_id, {page_text('html')} AS page_text FROM pages",
    "content_final": sql(
        f"""SELECT doc_id, {norm('content')} AS content_clean,
  coalesce(nullif({norm('content')}, ''), {page_text('content_html')}) AS content_final
FROM articles""",
        "articles",
    ),
    "title_normalized": f"""SELECT doc_id, regexp_replace({norm('text')},
  '[^\\p{{L}}\\p{{N}}_{WS}\\-.,!?]', '', 'g') AS title_normalized FROM documents""",
    "text_metrics": f"""SELECT doc_id, length(text)::INT AS content_length,
  len(regexp_extract_all(text, '[^{WS}]+'))::INT AS word_count FROM documents""",
    "detect_language_vote": sql(
        f"""SELECT doc_id, fr AS fr_votes, en AS en_votes,
  CASE WHEN coalesce(content, '') = '' THEN 'unknown' WHEN fr > en THEN 'fr'
       WHEN en > fr THEN 'en' ELSE 'mixed' END AS detected_language
FROM (SELECT *, {count_of("lower(coalesce(content, ''))", C.FRENCH_INDICATORS)} AS fr,
  {count_of("lower(coalesce(content, ''))", C.ENGLISH_INDICATORS)} AS en FROM articles)""",
        "articles",
    ),
    "detect_language_ngram": with_languages(
        "doc_id", "documents", "text",
        """SELECT doc_id, coalesce(language, 'unknown') AS language
FROM documents LEFT JOIN languages ON key = doc_id""",
    ),
    "quality_score": sql(
        """SELECT doc_id, data_quality_score,
  data_quality_score::DECIMAL(3,2) AS score_dec FROM measured""",
        "measured",
    ),
    "infer_theme": sql(f"SELECT doc_id, {DETAIL_THEME} AS theme FROM articles", "articles"),
    "recent_hour": sql(
        f"""SELECT article_id, title, coalesce(scraped_at, created_at) AS scraped_at FROM detail
WHERE coalesce(scraped_at, created_at) > {AS_OF} - INTERVAL 1 HOUR
ORDER BY 3 DESC, 1""",
        "detail",
    ),
    "trend_by_day": sql(
        f"""SELECT {DAY}, count(*) AS articles_count FROM detail
WHERE published_at::DATE >= DATE '2024-01-31' - 7 GROUP BY 1 ORDER BY 1 NULLS LAST""",
        "detail",
    ),
    "hourly_by_source": sql(
        f"""SELECT date_trunc('hour', published_at) AS published_hour, source,
  count(*) AS articles_count FROM detail WHERE published_at >= {AS_OF} - INTERVAL 24 HOUR
GROUP BY 1, 2 ORDER BY 1, 2""",
        "detail",
    ),
    "articles_for_source": sql(
        "SELECT article_id, source, title, published_at FROM detail WHERE source = 'Hespress'",
        "detail",
    ),
    "quarantine_reasons": sql("SELECT doc_id, quarantine, reason FROM judged", "judged"),
    "suspicious_title": sql(
        f"""SELECT doc_id, coalesce(length(t) < 15 OR {any_of('lower(t)', C.TITLE_BLACKLIST)}
  OR length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) > length(t) * 0.6, true) AS suspicious
FROM (SELECT *, {strip('title')} AS t FROM articles)""",
        "articles",
    ),
    "suspicious_url": sql(
        f"""SELECT doc_id, NOT (starts_with(u, 'http://') OR starts_with(u, 'https://'))
  OR {broken('h')} OR CASE s
    WHEN 'bbc news' THEN NOT (contains(h, 'bbc.com') AND starts_with(p, '/news/'))
    WHEN 'hespress' THEN NOT (contains(h, 'hespress.com') AND ends_with(p, '.html'))
    WHEN 'reuters world' THEN NOT (contains(h, 'reuters.com') AND contains(p, '/world/'))
    ELSE false END AS suspicious
FROM (SELECT *, {host('u')} AS h, {path('u')} AS p FROM (
  SELECT *, {strip("coalesce(url, '')")} AS u, lower(coalesce(source, '')) AS s FROM articles))""",
        "articles",
    ),
    "split_quarantine": sql(
        f"""SELECT CASE WHEN quarantine THEN 'quarantined' ELSE 'reliable' END AS side,
  {DETAIL_COLUMNS} FROM ({RECENT.format('detail')})""",
        "detail",
    ),
    "country_lookup": sql(
        """SELECT doc_id, source, coalesce(country, 'Unknown') AS source_country
FROM articles LEFT JOIN sources ON source = name""",
        "articles", "sources",
    ),
    "orphan_audit": sql(
        """SELECT * FROM audit q WHERE NOT EXISTS (
  SELECT 1 FROM upserted d WHERE d.article_id = q.article_id)""",
        "upserted", "audit",
    ),
    "backfill_audit": sql(
        f"""SELECT * FROM audit UNION ALL
SELECT article_id, 'mark', 'system', 'retroactive-backfill', {AS_OF} FROM upserted e
WHERE quarantine AND NOT EXISTS (SELECT 1 FROM audit q WHERE q.article_id = e.article_id
  AND q.action = 'mark' AND q.reason = 'retroactive-backfill')""",
        "upserted", "audit",
    ),
    "articles_by_day": sql(count_by(DAY, "detail"), "detail"),
    "articles_by_source": sql(BY_SOURCE, "detail"),
    "articles_by_theme": sql(count_by(f"{LAKE_THEME} AS theme", "lake"), "lake"),
    "articles_by_country": sql(BY_COUNTRY, "detail", "sources"),
    "articles_by_category": sql(count_by("category", "detail"), "detail"),
    "top_keywords_content": sql(LAKE_KEYWORDS, "lake"),
    "top_keywords_title": sql(TITLE_KEYWORDS, "detail"),
    "kpi_metrics": sql(
        """SELECT count(*) AS total_articles,
  count(*) FILTER (published_at::DATE = DATE '2024-01-31') AS articles_today,
  count(*) FILTER (quarantine) AS quarantined_articles,
  count(DISTINCT source) AS unique_sources FROM detail""",
        "detail",
    ),
    "analytics_summary": sql(
        f"""SELECT {AS_OF} AS summary_timestamp, count(*) AS total_articles,
  count(*) FILTER (published_at::DATE = DATE '2024-01-31') AS articles_today,
  count(*) FILTER (quarantine) AS quarantined_articles,
  count(DISTINCT source) AS unique_sources,
  {AVG_SCORE} AS avg_quality_score,
  count(DISTINCT detected_language) AS languages_detected FROM measured""",
        "measured",
    ),
    "daily_article_trends": sql(
        f"""SELECT published_at::DATE AS trend_date, source, count(*) AS articles_count,
  round(avg(word_count))::INT AS avg_word_count,
  {AVG_SCORE} AS avg_quality_score
FROM measured WHERE published_at IS NOT NULL GROUP BY 1, 2""",
        "measured",
    ),
    "total_articles": sql(
        """SELECT 'Toutes' AS source, 7 AS days, count(*) AS total FROM detail
  WHERE published_at::DATE >= DATE '2024-01-31' - 7
UNION ALL SELECT 'Toutes', 30, count(*) FROM detail
UNION ALL SELECT 'BBC News', 7, count(*) FROM detail WHERE source = 'BBC News'""",
        "detail",
    ),
    "quality_report_lake": sql(
        f"""SELECT n AS record_count, t AS article_sans_titre, d AS date_manquante,
  s AS contenu_trop_court, round(100 * (1 - (t + d) / (2 * greatest(n, 1))), 2) AS completude,
  round(100 * (1 - s / greatest(n, 1)), 2) AS coherence,
  round(100 * (1 - (t + d + s) / (3 * greatest(n, 1))), 2) AS validite
FROM (SELECT count(*) AS n, count(*) FILTER ({norm('title')} = '') AS t,
  count(*) FILTER (published_at IS NULL) AS d,
  count(*) FILTER (length(content_final) < 200) AS s FROM lake)""",
        "lake",
    ),
    "recent_per_source": sql(
        f"""SELECT article_id, title, author, source, published_at, url, quarantine
FROM ({RECENT.format('detail')})""",
        "detail",
    ),
    "dedup_keep_last": sql("SELECT * FROM latest", "latest"),
    "top_source": sql(
        """SELECT coalesce(max(source), 'N/A') AS source,
  coalesce(max(articles_count), 0) AS articles_count FROM (
    SELECT source, count(*) AS articles_count FROM detail GROUP BY 1
    ORDER BY 2 DESC, 1 NULLS LAST LIMIT 1)""",
        "detail",
    ),
    "sources_ranked": sql(BY_SOURCE, "detail"),
    "themes_ranked": sql(count_by(f"{LAKE_THEME} AS theme", "lake"), "lake"),
    "latest_for_source": sql(
        """SELECT article_id, title, source, published_at, url FROM detail
WHERE source = 'BBC News' ORDER BY published_at DESC NULLS FIRST, article_id LIMIT 10""",
        "detail",
    ),
    "keywords_top25": sql(
        f"SELECT * FROM ({TITLE_KEYWORDS}) ORDER BY frequency DESC, keyword LIMIT 25", "detail"
    ),
    "sources_top5": sql(f"{BY_SOURCE} ORDER BY 2 DESC, 1 NULLS LAST LIMIT 5", "detail"),
    "countries_ranked": sql(BY_COUNTRY, "detail", "sources"),
    "bronze_union": sql("SELECT * FROM bronze", "bronze"),
    "distinct_sources": sql("SELECT DISTINCT source FROM detail", "detail"),
    "source_options": sql(
        """SELECT source, min(position) AS position FROM (
  SELECT 'Toutes' AS source, 0::BIGINT AS position
  UNION ALL SELECT name, row_number() OVER () FROM sources
  UNION ALL SELECT source, 5 FROM detail) GROUP BY 1""",
        "detail", "sources",
    ),
    "upsert_articles": sql(UPSERTED, "existing", "incoming"),
    "quarantine_audit_delta": sql(
        f"""SELECT article_id, CASE WHEN quarantine THEN 'mark' ELSE 'unmark' END AS action,
  'system' AS performed_by,
  CASE WHEN quarantine THEN reason ELSE 'heuristic-change' END AS reason, {AS_OF} AS performed_at
FROM incoming LEFT JOIN {PREV} ON article_id = id WHERE coalesce(was, false) <> quarantine""",
        "existing", "incoming",
    ),
    "replace_by_key": sql(
        """SELECT article_id, title, title_normalized, author, content, content_clean,
  content_length::INT AS content_length, word_count::INT AS word_count, source, category,
  detected_language, published_at, url, canonical_url, data_quality_score, scraped_at
FROM measured WHERE doc_id IN (
    SELECT doc_id FROM incoming UNION ALL SELECT doc_id FROM existing
    WHERE article_id NOT IN (SELECT article_id FROM incoming))""",
        "measured", "existing", "incoming",
    ),
    "purge_articles": sql(
        f"SELECT {DETAIL_COLUMNS} FROM upserted WHERE NOT {EXPIRED}", "upserted"
    ),
    "purge_audit": sql(
        f"""SELECT * FROM audit WHERE article_id NOT IN (
  SELECT article_id FROM upserted WHERE {EXPIRED})""",
        "upserted", "audit",
    ),
    "purge_counts": sql(
        f"""SELECT (SELECT count(*) FROM upserted WHERE {EXPIRED}) AS articles_deleted,
  (SELECT count(*) FROM audit WHERE article_id IN (
    SELECT article_id FROM upserted WHERE {EXPIRED})) AS audit_deleted""",
        "upserted", "audit",
    ),
    "approve_articles": sql(
        f"""SELECT {DETAIL_COLUMNS.replace('quarantine', _APPROVED)} FROM upserted""",
        "upserted",
    ),
    "approve_audit": sql(
        f"""SELECT article_id, 'unmark' AS action, 'ui' AS performed_by, 'approved_ui' AS reason,
  {AS_OF} AS performed_at FROM ({RECENT.format('upserted')}) WHERE quarantine""",
        "upserted",
    ),
    "evolve_schema": sql(
        "SELECT "
        + DETAIL_COLUMNS.replace("canonical_url", "NULL::VARCHAR AS canonical_url").replace(
            "quarantine", "false AS quarantine"
        )
        + " FROM upserted",
        "upserted",
    ),
    "transformation_audit": sql(
        f"""SELECT article_id, transformation_type, input_value, output_value,
  {AS_OF} AS performed_at, {AS_OF} AS transformation_timestamp FROM (
    SELECT article_id, doc_id, 'title_normalized' AS transformation_type, title AS input_value,
      title_normalized AS output_value FROM measured
    UNION ALL SELECT article_id, doc_id, 'content_clean', content, content_clean FROM measured)
WHERE input_value IS DISTINCT FROM output_value""",
        "measured",
    ),
    "silver_warehouse": sql(
        f"""
{SILVER.format("t.created_at", "coalesce(t.ingested_at, t.created_at)", "existing")}
WHERE m.article_id NOT IN (SELECT article_id FROM fresh_ids)
UNION ALL
{SILVER.format(AS_OF, "coalesce(t.ingested_at, t.created_at)", "fresh")}""",
        "measured", "existing", "incoming",
    ).replace(
        "\nSELECT m.article_id",
        f""",
fresh AS (SELECT doc_id, ingested_at, created_at FROM (
    SELECT doc_id, ingested_at, created_at FROM incoming
    UNION ALL SELECT doc_id, ingested_at, created_at FROM existing
    WHERE article_id NOT IN (SELECT article_id FROM incoming))
  WHERE coalesce(ingested_at, created_at) > {AS_OF} - INTERVAL 1 HOUR),
fresh_ids AS (SELECT article_id FROM measured JOIN fresh USING (doc_id))
SELECT m.article_id""",
        1,
    ),
    "silver_lake": with_languages(
        "coalesce(url, ' ')", "lake", "content_final",
        """SELECT lake.*, coalesce(language, 'unknown') AS language
FROM lake LEFT JOIN languages ON key = coalesce(url, ' ')""",
        "lake",
    ),
    "quality_suite": sql(CHECK_STATUS, "upserted", "audit", "measured"),
    "quality_summary": sql(
        f"""SELECT CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' ELSE 'PASS' END AS status,
  count(*) AS total_checks, count(*) FILTER (status = 'PASS') AS passed,
  count(*) FILTER (status <> 'PASS') AS failed,
  count(*) FILTER (status = 'PASS') / count(*) * 100 AS pass_rate FROM ({CHECK_STATUS})""",
        "upserted", "audit", "measured",
    ),
    "stream_decode": sql(
        f"""SELECT {BRONZE_COLUMNS}, 'streaming' AS ingestion_mode, ingested_at,
  {iso(AS_OF)} AS stream_received_at FROM batch WHERE category IS NOT NULL""",
        "batch",
    ),
    "stream_drain": sql(
        f"""SELECT {BRONZE_COLUMNS}, 'streaming' AS ingestion_mode, ingested_at FROM batch""",
        "batch",
    ),
    "stream_sink": sql(
        """SELECT 'streaming' AS ingestion_mode, count(*) AS articles,
  count(*) AS in_date_folder FROM batch""",
        "batch",
    ),
    "stream_upsert": sql(UPSERTED, "existing", "incoming"),
    "set_aside": sql(
        """WITH arrived AS (SELECT * FROM batch)
SELECT reason, n FROM (
  SELECT 'no article_id' AS reason, count(*) AS n FROM arrived WHERE category IS NULL
  UNION ALL SELECT 'article_id repeated in the batch', count(*) - count(DISTINCT article_id)
    FROM arrived WHERE category IS NOT NULL
  UNION ALL SELECT 'not an article', count(*) FROM arrived WHERE category IS NULL
  UNION ALL SELECT 'empty message', count(*) FROM arrived WHERE title IS NULL) WHERE n > 0""",
        "batch",
    ).replace("\nWITH arrived AS (", ",\narrived AS ("),
    "silver_lake_hours": sql("SELECT *, 'unknown' AS language FROM lake", "lake"),
    "sources_dim": sql(
        "SELECT name, country, rss_url, count(article_id) AS articles_count FROM (VALUES "
        + ", ".join(f"('{n}', '{c}', '{u}')" for n, c, u in C.SOURCES)
        + ") v(name, country, rss_url) LEFT JOIN articles ON source = name GROUP BY ALL",
        "articles",
    ),
}
FRESH = f"""
fresh AS (SELECT doc_id, ingested_at, created_at FROM (
    SELECT doc_id, ingested_at, created_at FROM incoming
    UNION ALL SELECT doc_id, ingested_at, created_at FROM existing
    WHERE article_id NOT IN (SELECT article_id FROM incoming))
  WHERE coalesce(ingested_at, created_at) > {AS_OF} - INTERVAL 1 HOUR)"""


def after(inputs: str, ctes: str) -> str:
    """SQL with more CTEs after the inputs."""
    return f"{inputs.rstrip()},\n{ctes.strip()}"


_AT_HAND = "SELECT article_id, title, content, source, category, published_at FROM upserted"
ORACLES |= {
    "stored_silver_hour": after(sql("", "measured", "existing", "incoming"), FRESH)
    + SILVER.format(AS_OF, "coalesce(t.ingested_at, t.created_at)", "fresh"),
    "gold_by_batches": after(
        sql("", "upserted", "sources"), f"left_over AS ({_AT_HAND} WHERE NOT {EXPIRED})"
    )
    + "\n"
    + long_form(
        {
            "articles_by_day": count_by("published_at::DATE", "left_over"),
            "articles_by_source": count_by("source", "left_over"),
            "articles_by_theme": count_by(DETAIL_THEME, "left_over"),
            "articles_by_country": BY_COUNTRY.replace("FROM detail", "FROM left_over"),
            "articles_by_category": count_by("category", "left_over"),
            "top_keywords": keywords("title", "left_over", C.WAREHOUSE_STOPWORDS, 100),
        }
    ),
    "trends_by_batches": after(
        sql("", "measured", "existing", "incoming"),
        FRESH
        + f""",
earlier AS (SELECT doc_id, article_id FROM existing
  WHERE coalesce(ingested_at, created_at) > {AS_OF} - INTERVAL 2 HOUR),
fresh_ids AS (SELECT article_id FROM measured JOIN fresh USING (doc_id)),
shown AS (SELECT doc_id FROM fresh UNION ALL SELECT doc_id FROM earlier
  WHERE article_id NOT IN (SELECT article_id FROM fresh_ids))""",
    )
    + f"""
SELECT published_at::DATE AS trend_date, source, count(*) AS articles_count,
  round(avg(word_count))::INT AS avg_word_count, {AVG_SCORE} AS avg_quality_score
FROM measured WHERE doc_id IN (SELECT doc_id FROM shown) AND published_at IS NOT NULL GROUP BY 1, 2""",
    "stored_columns": sql(
        """SELECT *, CASE WHEN source = 'BBC News' THEN 'desk' ELSE 'nobody' END AS checked_by
FROM upserted""",
        "upserted",
    ),
}
# Statements with parameters: one source has a quote in its name.
_QUOTED = "L''Officiel"
NEEDS["renamed"] = ["detail"]
INPUTS["renamed"] = f"""SELECT * REPLACE (
  CASE WHEN source = 'France24' THEN '{_QUOTED}' ELSE source END AS source) FROM detail"""
_OF_SOURCE = f"FROM renamed WHERE source = '{_QUOTED}'"
_IN_WINDOW = "FROM renamed WHERE published_at::DATE >= DATE '2024-01-31' - 7"
ORACLES |= {
    f"statement_{name}": sql(body, "renamed")
    for name, body in {
        "source_total": f"SELECT count(*) AS total {_OF_SOURCE}",
        "window_total": f"SELECT count(*) AS total {_IN_WINDOW}",
        "top_source": """SELECT source, count(*) AS articles_count FROM renamed GROUP BY 1
ORDER BY 2 DESC, 1 NULLS LAST LIMIT 1""",
        "recent_of_source": f"""SELECT article_id, title, author, published_at, url, quarantine
{_OF_SOURCE} ORDER BY published_at DESC NULLS FIRST, article_id LIMIT 10""",
        "hourly_of_source": f"""SELECT date_trunc('hour', published_at) AS published_hour,
  count(*) AS articles_count {_OF_SOURCE}
  AND published_at >= {AS_OF} - INTERVAL 24 HOUR GROUP BY 1""",
        "day_series": f"SELECT {DAY}, count(*) AS articles_count {_IN_WINDOW} GROUP BY 1",
    }.items()
}
ORACLES["stream_drain_bounded"] = ORACLES["stream_drain"]
ORACLES["quality_by_hours"] = ORACLES["quality_report_lake"]
ORACLES["quality_by_batches"] = ORACLES["quality_suite"]
# The same operations on stored tables give what they give on frames.
ORACLES |= {
    "stored_purge": ORACLES["purge_articles"],
    "stored_purge_audit": ORACLES["purge_audit"],
    "stored_approve": ORACLES["approve_articles"],
    "stored_backfill": ORACLES["backfill_audit"],
    "batch_ingest": ORACLES["extract_articles"],
}
