"""SQL statements that say what each registered query has to return."""

from bookbase.functions.text import BLANKS, DIGIT, MISSING, NAME_WORD, NOISE, SENTENCE_END, STOP_WORDS, TITLE_CASE
from bookbase.operators import ask as A
from bookbase.operators import lookup as L
from bookbase.operators.clean import FILL
from bookbase.operators.lemma import NOUN_RULES
from bookbase.sources.catalogue import CLEAN_FIELDS, RAW_FIELDS
from bookbase.sources.pages import PAGE_URL


def text(value):
    return "'" + value.replace("'", "''") + "'"


def array(values):
    return "[" + ", ".join(text(v) for v in values) + "]"


BLANK_RUN = text(BLANKS)
STOP = array(STOP_WORDS)


def words(x):
    return f"list_filter(string_split_regex({x}, {BLANK_RUN}), lambda w: w <> '')"


def squeeze(x):
    return f"trim(regexp_replace({x}, {BLANK_RUN}, ' ', 'g'))"


def strip(x):
    return f"regexp_replace({x}, {text(f'^{BLANKS}|{BLANKS}$')}, '', 'g')"


def clean(x):
    return f"lower({squeeze(f'''regexp_replace(regexp_replace({x}, {text(NOISE)}, ' ', 'g'), {text(chr(39) * 2)}, ' ', 'g')''')})"


def strip_dates(x):
    return squeeze(f"regexp_replace(replace(translate({x}, '-–', '  '), '?', ''), {text(f'[{DIGIT}]')}, '', 'g')")


def no_stop(x):
    return f"array_to_string(list_filter({words(x)}, lambda w: NOT list_contains({STOP}, lower(w))), ' ')"


def keywords(x):
    kept = (
        rf"list_filter(string_split_regex(lower({x}), '[^\p{{L}}\p{{N}}_]+'), "
        rf"lambda w: regexp_full_match(w, '\p{{L}}+') AND NOT list_contains({STOP}, w))"
    )
    return f"array_to_string({kept}[1:20], ' ')"


TITLE6 = f"array_to_string({words('text')}[1:6], ' ')"

BOOKS = f"""books AS (SELECT doc_id AS ebook_no, {TITLE6} AS title, source AS author, lang AS subject,
  text AS summary, doc_id AS pos FROM documents)"""
CATALOGUE = """catalogue AS (SELECT p_partkey AS ebook_no, p_name AS title, p_brand AS author, p_type AS subject,
  p_partkey AS pos FROM part)"""
QUESTIONS = "questions AS (SELECT conv_id * 100 + turn AS qid, text FROM conversations WHERE role = 'user')"
BOOK_KEY = "sha256(concat_ws(chr(1), coalesce(author, ''), coalesce(title, ''), ebook_no::VARCHAR))"

RAW = f"""raw AS (SELECT doc_id AS page_id, lang,
  printf('%s, %s–?, 18%02d-1%d', source, upper(lang), n_chars % 100, 900 + n_chars % 50) AS "Author",
  CASE WHEN n_chars % 11 = 0 THEN 'None' ELSE {TITLE6} END AS "Title", NULL::VARCHAR AS "Note", text AS "Summary",
  lang AS "Language", 'PS' AS "LoC Class",
  CASE WHEN n_chars % 13 <> 0 THEN printf('%s (%s); fictions', lang, source) END AS "Subject", 'Text' AS "Category",
  doc_id::VARCHAR AS "EBook-No.",
  CASE WHEN n_chars % 7 = 0 THEN 'NaN' ELSE printf('day %d', n_chars) END AS "Release Date",
  NULL::VARCHAR AS "Most Recently Updated", 'free' AS "Copyright Status", n_chars::VARCHAR AS "Downloads" FROM documents)"""
CLEAN_COLUMNS = ", ".join(f'"{f}"' for f in CLEAN_FIELDS)
VOCAB = f"vocab AS (SELECT DISTINCT unnest({words(clean('text'))}) AS word FROM documents WHERE lang = 'en')"


def filled(name):
    return f"""CASE WHEN "{name}" IS NULL OR "{name}" IN ({', '.join(text(m) for m in MISSING)})
      THEN {text(FILL[name])} ELSE "{name}" END"""


def lemmas(source, out):
    """CTEs that turn source(id, col, t) into out(id, col, t) with every word in lemma form."""
    forms = " UNION ALL ".join(
        f"SELECT w, {i + 1} AS turn, left(w, length(w) - {len(end)}) || {text(new)} AS form FROM {out}_d WHERE suffix(w, {text(end)})"
        for i, (end, new) in enumerate(NOUN_RULES)
    )
    return f"""{out}_l AS (SELECT id, col, {words('t')} AS ws FROM {source}),
{out}_t AS (SELECT id, col, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM {out}_l),
{out}_d AS (SELECT DISTINCT w FROM {out}_t),
{out}_c AS (SELECT w, 0 AS turn, w AS form FROM {out}_d UNION ALL {forms}),
{out}_b AS (SELECT w, form FROM {out}_c SEMI JOIN vocab ON form = word
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY length(form), turn) = 1),
{out}_j AS (SELECT id, col, string_agg(coalesce(form, w), ' ' ORDER BY pos) AS t
  FROM {out}_t LEFT JOIN {out}_b USING (w) GROUP BY ALL),
{out} AS (SELECT s.id, s.col, CASE WHEN s.t IS NOT NULL THEN coalesce(j.t, '') END AS t
  FROM {source} s LEFT JOIN {out}_j j USING (id, col))"""


def embedded(name, source):
    """CTEs that turn source(id, text) into name(id, bucket, weight)."""
    return f"""{name}_t AS (SELECT id, unnest({words(clean('text'))}) AS w FROM ({source})),
{name}_n AS (SELECT id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS bucket, count(*) AS n FROM {name}_t GROUP BY ALL),
{name} AS (SELECT id, bucket, (n / sqrt(sum(n * n) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS weight FROM {name}_n)"""


def ranked(k, metric="l2"):
    """CTEs that rank the rows of c against those of q: hits(qid, rank, ebook_no, distance)."""
    distance = "q2 + c2 - 2 * coalesce(dot, 0)" if metric == "l2" else "1 - coalesce(dot, 0) / sqrt(q2 * c2)"
    return f"""qn AS (SELECT id, sum(weight * weight) AS q2 FROM q GROUP BY id),
cn AS (SELECT id, sum(weight * weight) AS c2 FROM c GROUP BY id),
dots AS (SELECT q.id AS qid, c.id AS cid, sum(q.weight * c.weight) AS dot FROM q JOIN c USING (bucket) GROUP BY ALL),
hits AS (SELECT qn.id AS qid, cn.id AS ebook_no, round(greatest({distance}, 0), 6) AS distance,
    row_number() OVER (PARTITION BY qn.id ORDER BY round(greatest({distance}, 0), 6), cn.id) AS rank
  FROM qn CROSS JOIN cn LEFT JOIN dots ON dots.qid = qn.id AND dots.cid = cn.id QUALIFY rank <= {k})"""


QC = f"""{QUESTIONS}, {BOOKS}, {embedded('q', 'SELECT qid AS id, text FROM questions')},
{embedded('c', 'SELECT doc_id AS id, text FROM documents')}"""
ASKS = "asks AS (SELECT conv_id * 100 + turn AS qid, text FROM conversations WHERE role = 'user')"
TITLE_CASE_LIST = f"list_filter({words('summary')}, lambda w: regexp_matches(w, {text(TITLE_CASE)}))"


def in_order(items):
    """The distinct items of a list in order of first use."""
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


def name_line(ws):
    """Names in a column of words kept, everything between them turned into bars."""
    core = "regexp_replace(w, '^[^\\p{L}]+|[''’]s[^\\p{L}]*$|[^\\p{L}]+$', '', 'g')"
    named = f"""regexp_matches({core}, {text(NAME_WORD)}) AND NOT list_contains({STOP}, lower({core}))
      AND i > 1 AND NOT regexp_matches({ws}[i - 1], {text(SENTENCE_END)})"""
    opened = "CASE WHEN regexp_matches(w, '^[^\\p{L}]') THEN '| ' ELSE '' END"
    closed = "CASE WHEN regexp_matches(w, '[^\\p{L}]$') THEN ' |' ELSE '' END"
    return f"array_to_string(list_transform({ws}, lambda w, i: CASE WHEN {named} THEN {opened} || {core} || {closed} ELSE '|' END), ' ')"


def looked_up(value, default):
    return f"""WITH {QC}, {ranked(1)}
SELECT qid, coalesce({value}, {default}) AS answer, {value} IS NOT NULL AS found
FROM questions LEFT JOIN hits USING (qid) LEFT JOIN books USING (ebook_no)"""


def text_by_title(lines):
    pieces = r"string_split_regex(t.text, '\r\n|[\n-\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]')"
    ended = f"len({pieces}) <= {lines} AND {pieces}[-1] = ''"
    value = "t.text" if lines is None else (
        f"array_to_string({pieces}[1:CASE WHEN {ended} THEN len({pieces}) - 1 ELSE {lines} END], chr(10))"
    )
    some = "documents" if lines is None else "(SELECT * FROM documents SEMI JOIN labels USING (doc_id))"
    return f"""WITH {QC}, {ranked(1)}
SELECT qid, CASE WHEN hits.qid IS NULL THEN {text(L.NO_TEXT)} ELSE {value} END AS answer, t.text IS NOT NULL AS found
FROM questions LEFT JOIN hits USING (qid)
LEFT JOIN {some} t ON t.doc_id = hits.ebook_no"""


def first_match(asks, books, value, default, test):
    return f"""found AS (SELECT a.qid, arg_min(b.{value}, b.pos) AS v FROM {asks} a JOIN {books} b ON {test} GROUP BY a.qid)
SELECT qid, coalesce(v, {text(default)}) AS answer, v IS NOT NULL AS found FROM {asks} LEFT JOIN found USING (qid)"""


def dense(metric):
    a, b = "a.embedding::DOUBLE[]", "b.embedding::DOUBLE[]"
    return {
        "l2": f"greatest(pow(list_distance({a}, {b}), 2), 0)",
        "cosine": f"1 - list_inner_product({a}, {b}) / sqrt(list_inner_product({a}, {a}) * list_inner_product({b}, {b}))",
        "dot": f"1 - list_inner_product({a}, {b})",
    }[metric]


def dense_knn(metric, right="embeddings b"):
    d = f"round({dense(metric)}, 6)"
    d = f"CASE WHEN {d} = 0 THEN 0.0::DOUBLE ELSE {d} END"  # no negative zero
    return f"""SELECT a.vec_id AS qid, row_number() OVER (PARTITION BY a.vec_id ORDER BY {d}, b.vec_id) AS rank,
  b.vec_id AS ebook_no, {d} AS distance
FROM embeddings a SEMI JOIN documents ON doc_id = a.vec_id
CROSS JOIN (SELECT b.* FROM {right} SEMI JOIN documents ON doc_id = b.vec_id) b QUALIFY rank <= 5"""


REPLIES = f"""replies AS (SELECT p_partkey AS qid,
  (CASE WHEN p_partkey % 11 = 0 THEN '' ELSE 'Action : ' || (['find_author', 'get_subject', 'extract_characters',
    'fetch_full_text', 'sing_a_song'])[p_partkey % 5 + 1] || chr(10) END)
  || (CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'Titre :  ' || upper(p_name) || ' ' || chr(10) || 'that is all' END) AS reply,
  CASE WHEN p_partkey % 11 <> 0 THEN (['find_author', 'get_subject', 'extract_characters', 'fetch_full_text',
    'sing_a_song'])[p_partkey % 5 + 1] END AS action,
  CASE WHEN p_partkey % 11 <> 0 AND p_partkey % 7 <> 0 THEN upper(p_name) END AS title FROM part)"""


def prompt(question, context):
    shown = text(A.PROMPT)
    for slot, value in [("{tools}", text(A.tools_line())), ("{question}", question), ("{context}", context)]:
        shown = shown.replace(slot, f"' || {value} || '", 1)
    return shown


def batch():
    asked = (
        f"SELECT conv_id * 100 + turn AS qid, text FROM conversations WHERE role = 'user' AND len({words('text')}) > 7"
    )
    return f"""WITH asked AS ({asked}), {BOOKS}, {embedded('q', 'SELECT qid AS id, text FROM asked')},
{embedded('c', 'SELECT doc_id AS id, text FROM documents')}, {ranked(1)},
rows AS (SELECT qid, lower(text) AS question, coalesce(summary, '') AS context
  FROM asked LEFT JOIN hits USING (qid) LEFT JOIN books USING (ebook_no))
SELECT qid, question, context, {prompt('question', 'context')} AS prompt FROM rows"""


def records(values, page="p_partkey", table="part"):
    columns = ", ".join(f"{values.get(f, text(''))} AS \"{f}\"" for f in RAW_FIELDS)
    return f"SELECT {page} AS page_id, {columns} FROM {table}"


def head(tag):
    value = f"regexp_extract(h, '(?s)<(?i:{tag})\\b[^>]*>(.*?)</(?i:{tag})\\s*>', 1)"
    value = f"regexp_replace({value}, '(?s)<[^>]*>', '', 'g')"
    for name, char in [("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("nbsp", " "), ("amp", "&")]:
        value = f"replace({value}, '&{name};', {text(char)})"
    return strip(value)


def statements():
    s = {}
    # sources and sinks
    s["src_page_ids"] = f"SELECT i AS page_id, printf({text(PAGE_URL)}, i) AS url FROM (SELECT unnest(range((SELECT max(page_id) + 1 FROM pages))) AS i)"
    s["src_pages"] = "SELECT page_id, url, length(html) AS size FROM pages WHERE html <> ''"
    raw_columns = ", ".join(f'"{f}"' for f in RAW_FIELDS)
    s["sink_raw_roundtrip"] = f"WITH {RAW} SELECT {raw_columns}, row_number() OVER (ORDER BY page_id) - 1 AS pos FROM raw"
    s["src_first_n"] = """SELECT p_brand AS "Author", p_name AS "Title",
  array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') || ' ' || p_brand AS "Summary",
  p_type AS "Subject", p_partkey::VARCHAR AS "EBook-No.", NULL::VARCHAR AS "Release Date",
  row_number() OVER (ORDER BY p_partkey) - 1 AS pos FROM part QUALIFY pos < 1500"""
    s["sink_clean_roundtrip"] = f"WITH {RAW} SELECT {CLEAN_COLUMNS} FROM raw"
    s["src_clean"] = f"WITH {RAW} SELECT {CLEAN_COLUMNS}, row_number() OVER (ORDER BY page_id) - 1 AS pos FROM raw"
    s["row_to_text"] = "SELECT p_partkey, 'p_name: ' || p_name || chr(10) || 'p_brand: ' || p_brand || chr(10) || 'p_type: ' || p_type AS document FROM part"
    s["text_to_fields"] = """SELECT p_partkey, 'p_name' AS field, p_name AS value FROM part
UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part UNION ALL SELECT p_partkey, 'p_type', p_type FROM part"""
    stored = f"WITH {BOOKS} SELECT b.*, {BOOK_KEY} AS book_key FROM books b SEMI JOIN embeddings ON vec_id = ebook_no"
    s["vec_load_or_create"] = f"SELECT book_key, ebook_no, title, author, subject FROM ({stored})"
    s["vec_append_new"] = f"SELECT book_key, ebook_no FROM ({stored})"
    s["vec_count"] = f"SELECT count(*) AS documents, CASE WHEN count(*) = 0 THEN 'the store holds no document' ELSE '' END AS note FROM ({stored})"
    s["vec_peek"] = f"SELECT book_key, summary AS text, title, author, ebook_no, subject FROM ({stored}) ORDER BY book_key LIMIT 10"
    # pages
    s["page_pairs"] = """SELECT p_partkey AS page_id, 0::BIGINT AS pos, 'Author' AS field, p_brand AS value FROM part
UNION ALL SELECT p_partkey, 1, 'Title', p_name || ' & more' FROM part
UNION ALL SELECT p_partkey, 2, 'Subject', 'first ' || p_type FROM part
UNION ALL SELECT p_partkey, 3, 'Shelf', 'unknown' FROM part UNION ALL SELECT p_partkey, 4, 'Subject', p_type FROM part
UNION ALL SELECT p_partkey, 5, 'EBook-No.', p_partkey::VARCHAR FROM part"""
    s["page_fields"] = records(
        {"Author": "p_brand", "Title": "p_name || ' & more'", "Subject": "p_type", "EBook-No.": "p_partkey::VARCHAR"}
    )
    s["page_fields_multi"] = "SELECT p_partkey AS page_id, p_name || ' & more' AS titles, 'first ' || p_type || '|' || p_type AS subjects FROM part"
    s["page_head"] = f"""SELECT page_id, {head('title')} AS title, {head('h1')} AS h1,
  regexp_extract(h, '(?s)<(?i:html)\\b[^>]*?\\s(?i:lang)\\s*=\\s*["'']?([^"''\\s>]+)', 1) AS lang
FROM (SELECT page_id, regexp_replace(html, '(?s)<!--.*?-->', '', 'g') AS h FROM pages)"""
    # cleaning
    s["clean_fill"] = f"WITH {RAW} SELECT page_id, " + ", ".join(f'{filled(f)} AS "{f}"' for f in CLEAN_FIELDS) + " FROM raw"
    author = strip_dates('"Author"')
    s["clean_author"] = f"WITH {RAW} SELECT page_id, {author} AS author FROM raw"
    s["clean_text"] = f"SELECT doc_id, {clean('text')} AS text FROM documents"
    s["clean_stopwords"] = f"SELECT doc_id, {no_stop(clean('text'))} AS text FROM documents"
    s["clean_lemma"] = f"""WITH {VOCAB}, s AS (SELECT doc_id AS id, '' AS col, {clean('text')} AS t FROM documents), {lemmas('s', 'o')}
SELECT id AS doc_id, t AS text FROM o"""
    s["clean_lemma_joined"] = s["clean_lemma"]
    s["clean_keywords"] = f"""WITH {VOCAB}, s AS (SELECT doc_id AS id, '' AS col, {keywords('text')} AS t FROM documents), {lemmas('s', 'o')}
SELECT id AS doc_id, t AS text FROM o"""

    def catalogue(source, page_columns):
        steps = f"""filled AS (SELECT page_id, {', '.join(f'{filled(f)} AS "{f}"' for f in CLEAN_FIELDS)} FROM {source}),
k AS (SELECT page_id AS id, 'Summary' AS col, {keywords('"Summary"')} AS t FROM filled), {lemmas('k', 'ko')},
s AS (SELECT page_id AS id, 'Author' AS col, {no_stop(clean(strip_dates('"Author"')))} AS t FROM filled
  UNION ALL SELECT page_id, 'Title', {no_stop(clean('"Title"'))} FROM filled
  UNION ALL SELECT page_id, 'Subject', {no_stop(clean('"Subject"'))} FROM filled
  UNION ALL SELECT id, 'Summary', {no_stop(clean('t'))} FROM ko), {lemmas('s', 'o')}"""
        picks = ", ".join(f"max(t) FILTER (col = '{f}') AS \"{f}\"" for f in ["Author", "Title", "Summary", "Subject"])
        return f"""WITH {VOCAB}, {page_columns}, {steps}
SELECT p.*, "EBook-No.", "Release Date" FROM (SELECT id AS page_id, {picks} FROM o GROUP BY id) p JOIN filled USING (page_id)"""

    s["clean_catalogue"] = catalogue("raw", RAW)
    s["catalogue_job"] = catalogue("pagerows", f"pagerows AS ({s['page_fields']})")
    s["catalogue_books"] = f"""SELECT try_cast(c."EBook-No." AS BIGINT) AS ebook_no, c."Title" AS title, c."Author" AS author,
  c."Subject" AS subject, coalesce(d.text, c."Summary") AS summary, c.page_id AS pos
FROM ({s['clean_catalogue']}) c JOIN documents d ON c.page_id = d.doc_id"""
    s["catalogue_dropped"] = f"""SELECT count(*) AS books,
  coalesce(sum(CASE WHEN text IS NULL OR {clean('text')} = '' THEN 1 ELSE 0 END), 0)::BIGINT AS dropped FROM documents"""
    s["build_store_rows"] = f"""WITH {BOOKS} SELECT {BOOK_KEY} AS book_key, ebook_no, title, author, summary AS text
FROM books WHERE {clean('summary')} <> ''"""
    # keys and chunks
    s["key_hash"] = f"WITH {CATALOGUE} SELECT ebook_no, {BOOK_KEY} AS book_key FROM catalogue"
    s["chunk_recursive"] = f"""SELECT doc_id, true AS fits, true AS covered,
  CASE WHEN length(text) <= 1500 THEN {strip('text')} END AS only FROM documents WHERE {strip('text')} <> ''"""
    s["key_uuid"] = "SELECT count(*) AS keyed, count(*) AS different, 0::BIGINT AS malformed FROM part"
    s["key_seq"] = """WITH free AS (SELECT i, row_number() OVER (ORDER BY i) AS n
  FROM (SELECT unnest(range(1, (SELECT count(*) FROM part) + (SELECT count(*) FROM labels) + 1)) AS i)
  WHERE i NOT IN (SELECT doc_id + 1 FROM labels)),
numbered AS (SELECT p_partkey AS ebook_no, row_number() OVER (ORDER BY p_partkey) AS n FROM part)
SELECT ebook_no, i AS book_key FROM numbered JOIN free USING (n)"""
    s["key_name"] = """SELECT p_partkey AS ebook_no, p_name || '_' || p_brand || CASE WHEN n = 1 THEN '' ELSE '_' || (n - 1) END AS book_key
FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) AS n FROM part)"""
    s["batch_no"] = "SELECT p_partkey AS ebook_no, (row_number() OVER (ORDER BY p_partkey) - 1) // 32 AS batch FROM part"
    s["meta_struct"] = f"WITH {CATALOGUE} SELECT pos, title, author, ebook_no, subject FROM catalogue"
    s["chunk_fixed"] = """SELECT doc_id, i AS chunk_no, substring(text, i * 1350 + 1, 1500) AS chunk
FROM (SELECT doc_id, text, unnest(range(greatest(1, (length(text) - 150 + 1349) // 1350))) AS i FROM documents WHERE text <> '')"""
    # vectors
    docs = embedded("c", "SELECT doc_id AS id, text FROM documents")
    s["embed_hash"] = f"WITH {docs} SELECT id AS doc_id, bucket, round(weight, 6) AS weight FROM c"
    s["embed_idf"] = f"""WITH {docs}, f AS (SELECT bucket, ln((1 + (SELECT count(DISTINCT id) FROM c_n)) / (1 + count(*))) + 1 AS idf FROM c_n GROUP BY bucket),
w AS (SELECT id, bucket, n * idf AS x FROM c_n JOIN f USING (bucket))
SELECT id AS doc_id, bucket, round((x / sqrt(sum(x * x) OVER (PARTITION BY id)))::FLOAT::DOUBLE, 5) AS weight FROM w"""
    s["embed_norm"] = f"WITH {docs} SELECT id AS doc_id, round(sum(weight * weight), 4) AS norm FROM c GROUP BY id"
    s["embed_questions"] = f"WITH {QUESTIONS}, {embedded('q', 'SELECT qid AS id, text FROM questions')} SELECT id AS qid, bucket, round(weight, 6) AS weight FROM q"
    cleaned = f"SELECT doc_id, {clean('text')} AS t FROM documents"
    s["embed_model"] = f"SELECT doc_id, length(t) AS size, length(t) - length(replace(t, ' ', '')) AS blanks FROM ({cleaned}) WHERE t <> ''"
    for metric in ("l2", "cosine", "dot"):
        s[f"knn_{metric}"] = s[f"knn_{metric}_cells"] = dense_knn(metric)
    s["store_append_indexed"] = s["knn_tree_l2"] = dense_knn("l2")
    apart = "list_sum(list_transform(list_zip({0}, {1}), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))"
    s["knn_approx"] = f"""WITH v AS (SELECT vec_id AS id, embedding AS e FROM embeddings SEMI JOIN documents ON doc_id = vec_id),
away AS (SELECT v.id, v.e, c.id AS cell, row_number() OVER (PARTITION BY v.id ORDER BY {apart.format('v.e', 'c.e')}, c.id) AS near
  FROM v, (SELECT * FROM v WHERE id < 16) c),
pairs AS (SELECT q.id AS qid, b.id AS ebook_no, round({apart.format('q.e', 'b.e')}, 6) AS distance
  FROM away q JOIN away b ON q.cell = b.cell WHERE q.near <= 8 AND b.near = 1),
hits AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, ebook_no) AS rank FROM pairs)
SELECT qid, rank, ebook_no, distance FROM hits WHERE rank <= 5"""
    s["knn_filtered"] = s["knn_filtered_indexed"] = dense_knn(
        "l2", "(SELECT e.* FROM embeddings e JOIN labels ON doc_id = vec_id WHERE quality = 1) b"
    )
    s["knn_rank_all"] = """WITH v AS (SELECT e.* FROM embeddings e SEMI JOIN documents ON doc_id = vec_id),
x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM v),
m AS (SELECT i, avg(x) AS m FROM x GROUP BY i)
SELECT vec_id AS ebook_no, round(sum((x - m) * (x - m)), 6) AS distance FROM x JOIN m USING (i) GROUP BY vec_id"""
    s["knn_sparse"] = f"WITH {QC}, {ranked(5, 'cosine')} SELECT qid, rank, ebook_no, distance FROM hits"
    # lookups
    s["lk_books_by_author"] = f"""WITH {QC}, {ranked(5)}
SELECT qid, coalesce(string_agg(title, ' | ' ORDER BY rank), '') AS answer, count(hits.qid) > 0 AS found
FROM questions LEFT JOIN hits USING (qid) LEFT JOIN books USING (ebook_no) GROUP BY qid"""
    s["lk_books_by_author_exact"] = f"""WITH {BOOKS}, {embedded('c', 'SELECT doc_id AS id, text FROM documents')},
asks AS (SELECT min(doc_id) AS qid, CASE WHEN min(doc_id) % 5 = 0 THEN 'no ' || source ELSE upper(source) END AS text
  FROM documents GROUP BY source)
SELECT qid, ebook_no, coalesce(title, {text(L.NO_TITLE)}) AS answer, ebook_no IS NOT NULL AS found
FROM asks LEFT JOIN (SELECT * FROM books WHERE ebook_no IN (SELECT id FROM c)) b ON lower(author) = lower(text)"""
    s["lk_author"] = looked_up("author", text(L.NO_AUTHOR))
    s["lk_author_indexed"] = s["lk_author"]
    of_texts, of_titles = (embedded("c", f"SELECT doc_id AS id, {t} AS text FROM documents") for t in ("text", TITLE6))
    s["lk_author_on_title"] = s["lk_author"].replace(of_texts.replace("text AS text", "text"), of_titles)
    s["lk_subject"] = looked_up("subject", text(L.NO_SUBJECT))
    s["lk_characters"] = looked_up(
        f"nullif(array_to_string({in_order(TITLE_CASE_LIST)}, ' | '), '')", text(L.NO_CHARACTERS)
    )
    spans = f"regexp_extract_all({name_line('ws')}, '[^| ]+(?: [^| ]+)+')"
    s["lk_character_spans"] = f"""WITH {QC}, {ranked(1)},
s AS MATERIALIZED (SELECT qid, {words('summary')} AS ws FROM hits JOIN books USING (ebook_no)),
n AS (SELECT qid, {spans} AS names FROM s)
SELECT qid, coalesce(nullif(array_to_string({in_order('names')}, ' | '), ''), {text(L.NO_CHARACTERS)}) AS answer,
  coalesce(len(names) > 0, false) AS found FROM questions LEFT JOIN n USING (qid)"""
    s["lk_text_head"] = text_by_title(50)
    s["lk_text_full"] = text_by_title(None)
    contains = "contains(lower(b.title), lower(a.text))"
    s["lk_contains_author"] = f"""WITH {CATALOGUE}, asks AS (SELECT p_partkey AS qid, CASE p_partkey % 4
    WHEN 0 THEN upper(p_name) WHEN 1 THEN substring(p_name, 3, 7)
    WHEN 2 THEN substring(string_split(p_name, ' ')[-1], 1, 3) ELSE p_name || ' ' || p_type END AS text FROM part),
""" + first_match("asks", "catalogue", "author", L.NO_AUTHOR, contains)
    s["lk_contains_subject"] = f"WITH {BOOKS}, {ASKS}, " + first_match("asks", "books", "subject", L.NO_SUBJECT, contains)
    s["lk_regex_author"] = f"""WITH {CATALOGUE}, asks AS (SELECT p_partkey AS qid, CASE p_partkey % 3
    WHEN 0 THEN '^' || string_split(p_name, ' ')[1] || '.*' || string_split(p_name, ' ')[-1] || '$'
    WHEN 1 THEN '(' || upper(string_split(p_name, ' ')[-1]) || '|' || string_split(p_name, ' ')[1] || ')'
    ELSE string_split(p_name, ' ')[-1] || '[0-9]' END AS text FROM part),
titles AS (SELECT title, arg_min(author, pos) AS author, min(pos) AS pos FROM catalogue GROUP BY title),
patterns AS (SELECT DISTINCT text FROM asks),
best AS (SELECT text, arg_min(author, pos) AS v FROM patterns JOIN titles ON regexp_matches(title, text, 'i') GROUP BY text)
SELECT qid, coalesce(v, {text(L.NO_AUTHOR)}) AS answer, v IS NOT NULL AS found FROM asks LEFT JOIN best USING (text)"""
    s["lk_fallback"] = f"""WITH {BOOKS}, {ASKS}, {embedded('q', 'SELECT qid AS id, text FROM asks')},
{embedded('c', 'SELECT doc_id AS id, text FROM documents')}, {ranked(1)},
near AS (SELECT qid, subject FROM hits JOIN books USING (ebook_no) WHERE distance <= 0.7),
matched AS (SELECT a.qid, arg_min(b.subject, b.pos) AS subject FROM asks a JOIN books b ON {contains}
  WHERE a.qid NOT IN (SELECT qid FROM near) GROUP BY a.qid)
SELECT qid, coalesce(n.subject, m.subject, {text(L.NO_SUBJECT)}) AS answer, coalesce(n.subject, m.subject) IS NOT NULL AS found
FROM asks LEFT JOIN near n USING (qid) LEFT JOIN matched m USING (qid)"""
    s["chars_title_case"] = f"SELECT DISTINCT doc_id, token FROM (SELECT doc_id, unnest({words('text')}) AS token FROM documents) WHERE regexp_matches(token, {text(TITLE_CASE)})"
    s["chars_spans"] = f"""WITH s AS MATERIALIZED (SELECT doc_id, {words('text')} AS ws FROM documents)
SELECT DISTINCT doc_id, unnest(regexp_extract_all({name_line('ws')}, '[^| ]+(?: [^| ]+)+')) AS name FROM s"""
    # questions
    s["q_guard"] = f"WITH {QUESTIONS} SELECT qid, text FROM questions WHERE len({words('text')}) > 7"
    s["q_retrieve"] = f"WITH {QC}, {ranked(3)} SELECT qid, rank, ebook_no, distance, summary AS text FROM hits JOIN books USING (ebook_no)"
    s["q_context"] = f"""WITH {QC}, {ranked(3)} SELECT qid, string_agg(summary, chr(10) || chr(10) ORDER BY rank) AS context
FROM hits JOIN books USING (ebook_no) GROUP BY qid"""
    s["q_prompt"] = f"WITH {QUESTIONS} SELECT qid, {prompt('text', 'lower(text)')} AS prompt FROM questions"
    s["q_parse_reply"] = f"WITH {REPLIES} SELECT qid, action, title FROM replies"
    s["q_route"] = f"""WITH {REPLIES}, {CATALOGUE},
names AS (SELECT lower(title) AS t, min(pos) AS pos FROM catalogue GROUP BY 1),
wants AS (SELECT DISTINCT lower(title) AS want FROM replies WHERE title IS NOT NULL),
best AS (SELECT want, min(pos) AS pos FROM wants JOIN names ON contains(t, want) GROUP BY want)
SELECT qid, action, coalesce(action IN ({', '.join(text(t) for t in A.TOOLS)}), false) AS known,
  CASE action WHEN 'find_author' THEN coalesce(p.p_brand, {text(L.NO_AUTHOR)})
    WHEN 'get_subject' THEN coalesce(p.p_type, {text(L.NO_SUBJECT)})
    WHEN 'extract_characters' THEN CASE WHEN p.p_name IS NULL THEN {text(L.NO_CHARACTERS)} ELSE
      array_to_string(list_transform(string_split(p.p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') || ' ' || p.p_brand END
    WHEN 'fetch_full_text' THEN coalesce(d.text, {text(L.NO_TEXT)}) END AS answer
FROM replies LEFT JOIN best ON best.want = lower(replies.title) LEFT JOIN part p ON p.p_partkey = best.pos
LEFT JOIN documents d ON d.doc_id = best.pos"""
    s["q_default"] = f"WITH {REPLIES} SELECT qid, CASE WHEN reply = '' THEN {text(A.NO_ANSWER)} ELSE reply END AS answer FROM replies"
    s["q_batch"] = s["q_stream"] = batch()
    tools = " UNION ALL ".join(f"SELECT {text(n)} AS name, {text(t)} AS description" for n, t in A.TOOLS.items())
    s["q_tools"] = f"""WITH {REPLIES}, tools AS ({tools})
SELECT name, description, count(action) AS uses FROM tools LEFT JOIN replies ON action = name GROUP BY ALL"""
    return s
