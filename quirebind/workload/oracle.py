"""DuckDB SQL for the registered queries.

Written the other way round from the Spark side wherever there is one: line by
line with windows, chunks by recursion, joins instead of arrays.  Named parts
are put together into one WITH per query.
"""

from quirebind import fixed
from quirebind.workload import fixtures as fx

NL = "chr(10)"
# --- fixed values: patterns that results must equal; texts stand in the parts below ---
WS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
HASH = r"^(?i)#+\s+(.+)"
CHAPTER = (
    r"^(?i)(?:CHAPTER|CAPÍTULO|CAPITULO|SECCIÓN|SECCION|PARTE)"
    r"\s+(\d+|[IVXLCDM]+)(?:[\s:-]+(.*))?$"
)
NUMBERED = r"^(\d+)\.\s+([A-ZÁÉÍÓÚÑ].{2,60})$"
LINK = r"\[.*?\]\((.*?\.md)\)"
# --- end of fixed values ---
GENERATED = f"TIMESTAMP '{fx.GENERATED_AT}'"
JOB_COLUMNS = (
    "job_id, user_id, original_filename, file_key, coalesce(bundle_key, '') AS bundle_key, "
    "status, coalesce(error_message, '') AS error_message, units_count, "
    "strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, "
    "strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at"
)


def trim(s: str) -> str:
    return f"regexp_replace({s}, '^{WS}+|{WS}+$', '', 'g')"


def uid(n: str) -> str:
    return f"printf('%08d-0000-4000-8000-%012d', ({n}) % 100000000, {n})"


def choose(values: list[str], n: str) -> str:
    return f"list_extract({values!r}, CAST(({n}) % {len(values)} AS INTEGER) + 1)"


def ext(f: str) -> str:
    return rf"regexp_extract({f}, '(\.[^./]*)$', 1)"


def stem(f: str) -> str:
    return f"left({f}, length({f}) - length({ext(f)}))"


def hashed(s: str) -> str:
    return (
        f"regexp_replace(md5({s}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', "
        r"'\1-\2-\3-\4-\5')"
    )


def title(t: str) -> str:
    sub = trim(f"regexp_extract({t}, '{CHAPTER}', 2)")
    return (
        f"CASE WHEN regexp_matches({t}, '{HASH}') THEN "
        f"{trim(f'''regexp_extract({t}, '{HASH}', 1)''')} "
        f"WHEN regexp_matches({t}, '{CHAPTER}') THEN 'Capítulo ' || "
        f"regexp_extract({t}, '{CHAPTER}', 1) || "
        f"CASE WHEN {sub} <> '' THEN ': ' || {sub} ELSE '' END "
        f"WHEN regexp_matches({t}, '{NUMBERED}') THEN 'Sección ' || "
        f"regexp_extract({t}, '{NUMBERED}', 1) || ': ' || regexp_extract({t}, '{NUMBERED}', 2) END"
    )


def ratio(s: str) -> str:
    t = trim(s)
    good = f"length(regexp_replace({t}, '[^a-zA-Z0-9 .,:;()áéíóúñÁÉÍÓÚÑ-]', '', 'g'))"
    return f"CASE WHEN length({t}) > 0 THEN {good} / CAST(length({t}) AS DOUBLE) ELSE 0.0 END"


def kept(s: str) -> str:
    return f"({trim(s)} <> '' AND {ratio(s)} >= 0.70)"


def lines_of(cte: str, key: str, text: str, more: str = "") -> str:
    return (
        f"SELECT {key}{more}, unnest(string_split({text}, {NL})) AS line, "
        f"generate_subscripts(string_split({text}, {NL}), 1) AS line_no FROM {cte}"
    )


def each_line(text: str, expr: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({text}, {NL}), "
        f"lambda x, i: {expr}), {NL})"
    )


def markup(text: str) -> str:
    esc = f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    par = (
        "'<w:p><w:pPr/><w:r><w:t xml:space=\"preserve\">- </w:t></w:r><w:r><w:t>' || x || "
        f"CASE WHEN length({text}) % 5 = 0 AND i = 3 THEN '</w:x></w:r></w:p>' "
        "ELSE '</w:t></w:r></w:p>' END"
    )
    return (
        "'<w:document><w:body>' || array_to_string(list_transform("
        f"string_split({esc}, {NL}), lambda x, i: {par}), '') || '</w:body></w:document>'"
    )


def structured(n: str, t: str) -> str:
    see = f"CASE WHEN {n} % 16 = 10 THEN ', see [notes](notes.md)' ELSE '' END"
    return (
        f"CASE {n} % 8 "
        f"WHEN 1 THEN replace({t}, {NL}, {NL} || {NL}) "
        f"WHEN 2 THEN {each_line(t, f'''concat('## Part ', i, {see}, {NL}, {NL}, x)''')} "
        f"WHEN 3 THEN {each_line(t, f'''concat('CHAPTER ', i, {NL}, 'Part ', i, {NL}, x)''')} "
        f"WHEN 4 THEN {each_line(t, f'''concat(i, '. Sección ', i, {NL}, x)''')} "
        f"WHEN 5 THEN concat(chr(160), chr(9), {NL}, '#tag', {NL}, {t}, {NL}, chr(9), '# Fin ', "
        f"chr(160), {NL}, 'fin', {NL}, ' ', chr(9), chr(160)) "
        f"WHEN 6 THEN {markup(t)} ELSE {t} END"
    )


def markup_text(x: str) -> str:
    """Pieces at each paragraph start, text runs of each, entities decoded; up to the one
    tag that may not match."""
    x = f"string_split({x}, '</w:x>')[1] || '</w:t>'"
    runs = (
        "array_to_string(regexp_extract_all(p, "
        r"'<(?:\w+:)?t(?:\s(?:[^>]*[^/>])?)?>([^<]*)</(?:\w+:)?t\s*>', 1), '')"
    )
    decoded = runs
    for name, char in [("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "''"), ("amp", "&")]:
        decoded = f"replace({decoded}, '&{name};', '{char}')"
    starts = rf"regexp_replace({x}, '<(?:\w+:)?p([\s/>])', chr(1) || '\1', 'g')"
    return trim(
        f"array_to_string(list_transform(string_split({starts}, chr(1)), lambda p: {decoded}), "
        f"{NL} || {NL})"
    )


def clean(t: str) -> str:
    return (
        f"array_to_string(list_filter(list_transform(string_split({t}, {NL}), "
        f"lambda x: {trim('x')}), lambda y: {kept('y')}), {NL} || {NL})"
    )


def prepared(t: str, f: str) -> str:
    head = f"'# ' || {stem(f)} || {NL} || {NL}"
    m, c = markup_text(t), clean(t)
    return (
        f"CASE WHEN lower({ext(f)}) = '.docx' THEN {head} || CASE WHEN {m} <> '' THEN {m} "
        "ELSE 'Contenido de texto vacío en el documento Word.' END "
        f"WHEN lower({ext(f)}) = '.pdf' THEN CASE WHEN {c} <> '' THEN {c} ELSE {head} || "
        "'*Nota: El archivo PDF procesado no contiene texto seleccionable o es una imagen "
        "escaneada.*' END "
        f"WHEN starts_with({trim(t)}, '#') THEN {t} ELSE {head} || {t} END"
    )


# --- named parts ------------------------------------------------------------

PARTS: dict[str, str] = {}
NEEDS: dict[str, list[str]] = {}


def part(name: str, needs: list[str], sql: str) -> None:
    PARTS[name], NEEDS[name] = sql, needs


def _doc(key: str) -> str:
    return f"{key} AS doc_id, 'doc_' || doc_id || {choose(fx.EXTENSIONS, 'doc_id')} AS filename"


part("fx_docs", [], f"""
SELECT {_doc("'doc_' || doc_id")}, {structured("doc_id", "text")} AS text FROM documents
UNION ALL
SELECT concat('turn_', conv_id, '_', turn), concat('turn_', conv_id, '_', turn, '.md'),
  concat('CHAPTER ', turn + 1, {NL}, role, {NL}, text) FROM conversations
UNION ALL
SELECT concat('page_', page_id), concat('page_', page_id, '.html'), html FROM pages""")
part("fx_job_docs", [], f"""
SELECT {_doc(uid("doc_id"))}, {structured("doc_id", "text")} AS text FROM documents""")
part("fx_stored", [], f"""
SELECT 'originals/' || {uid("doc_id % 100")} || '/' || {uid("doc_id")} ||
  {choose(fx.EXTENSIONS, "doc_id")} AS file_key, {structured("doc_id", "text")} AS text
FROM documents""")
part("fx_raw_docs", [], "SELECT 'doc_' || doc_id AS doc_id, text FROM documents")
part("fx_users", [], f"""
SELECT {uid("c_custkey")} AS user_id, lower(c_name) || '@example.com' AS email FROM customer""")
part("fx_jobs_base", [], f"""
SELECT o_orderkey AS n, {uid("o_orderkey")} AS job_id, {uid("o_custkey")} AS user_id,
  {choose(fx.UPLOAD_EXTENSIONS, "o_orderkey")} AS x,
  CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED' WHEN o_orderstatus = 'O' THEN 'PENDING'
    WHEN o_orderkey % 7 = 0 THEN 'FAILED' WHEN o_orderkey % 11 = 0 THEN 'INVALID'
    ELSE 'PROCESSING' END AS status,
  o_orderkey % 9 AS units_count, o_orderdate AS created_at FROM orders""")
part("fx_jobs", ["fx_jobs_base"], """
SELECT job_id, user_id, 'file_' || n || x AS original_filename,
  'originals/' || user_id || '/' || job_id || x AS file_key,
  CASE WHEN status = 'COMPLETED' THEN CASE WHEN n % 13 = 0 THEN ''
    ELSE 'bundles/' || user_id || '/' || job_id || '.zip' END END AS bundle_key,
  status, CASE WHEN status IN ('FAILED', 'INVALID') THEN 'error ' || n END AS error_message,
  units_count, created_at, created_at AS updated_at, n FROM fx_jobs_base""")
part("fx_logs", [], f"""
SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CAST(round(l_extendedprice * 100) AS BIGINT))) AS log_id,
  {uid("l_orderkey")} AS job_id, {choose(fx.STEPS, "l_linenumber - 1")} AS step,
  {choose(fx.SEVERITIES, "l_linenumber - 1")} AS status,
  'part ' || l_partkey || ' of supplier ' || l_suppkey AS message,
  l_shipdate + to_seconds(l_linenumber * 61) AS created_at FROM lineitem""")
part("fx_requests", [], f"""
SELECT 'r' || o_orderkey || 'a' AS request_id, {uid("o_orderkey")} AS job_id,
  {uid("o_custkey")} AS user_id FROM orders
UNION ALL SELECT 'r' || o_orderkey || 'b', {uid("o_orderkey")}, {uid("o_custkey + 1")}
FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT 'r' || o_orderkey || 'c', {uid("o_orderkey + 50000000000")}, {uid("o_custkey")}
FROM orders WHERE o_orderkey % 10 = 0""")
part("fx_deletes", [], f"""
SELECT {uid("o_orderkey")} AS job_id, {uid("o_custkey")} AS user_id FROM orders
WHERE o_orderstatus = 'F'
UNION ALL SELECT {uid("o_orderkey")}, {uid("o_custkey + 1")} FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT {uid("o_orderkey + 50000000000")}, {uid("o_custkey")} FROM orders
WHERE o_orderkey % 10 = 0""")
part("fx_registrations", [], f"""
SELECT CASE WHEN event_id % 2 = 0 THEN printf('customer#%09d@example.com', user_id)
  ELSE printf('new%d@example.com', event_id % 997) END AS email,
  {uid("event_id")} AS user_id, event_id AS arrival FROM events""")
part("fx_states", [], f"""
SELECT {uid("user_id")} AS job_id, event_id AS seq,
  {choose(fx.STATES, "event_id // 7 + event_id")} AS status, event_id FROM events""")
part("fx_uploads", [], f"""
SELECT 'u' || o_orderkey AS upload_id, {uid("o_custkey")} AS user_id,
  'dir.v1/file_' || o_orderkey || {choose(fx.UPLOAD_EXTENSIONS, "o_orderkey")} AS filename,
  o_orderdate AS created_at FROM orders""")
part("fx_messages_base", [], f"""
SELECT event_id AS arrival, event_type, event_id // 5 AS job,
  {uid("(event_id // 5) % 100")} AS user_id, {choose(fx.EXTENSIONS, "event_id // 5")} AS x,
  CASE WHEN event_id % 53 = 0 THEN 'job-' || event_id ELSE {uid("event_id // 5")} END AS job_id,
  strftime({GENERATED} - to_seconds(event_id), '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp FROM events""")
FIELDS = ("job_id", "user_id", "original_filename", "file_key", "timestamp")
UPPER = "payload"
for field in FIELDS:
    UPPER = f"""replace({UPPER}, '"{field}":', '"{field.upper()}":')"""
part("fx_messages", ["fx_messages_base"], f"""
SELECT arrival, CASE WHEN arrival % 50 = 0 THEN left(payload, 60) WHEN arrival % 61 = 0 THEN '{{}}'
  WHEN arrival % 67 = 0 THEN {UPPER}
  WHEN arrival % 71 = 0 THEN
    regexp_replace(payload, '"original_filename":"[^"]*"', '"original_filename":5')
  WHEN arrival % 73 = 0 THEN
    replace(payload, '"ignored":', '"FILE_KEY":"originals/none","ignored":')
  WHEN arrival % 59 = 0 THEN regexp_replace(payload, '"file_key":"[^"]*",', '')
  WHEN arrival % 79 = 0 THEN regexp_replace(payload, '"timestamp":"[^"]*",', '')
  ELSE payload END AS value FROM (
  SELECT arrival, CAST(json_object('job_id', job_id, 'user_id', user_id,
    'original_filename', 'doc_' || job || x,
    'file_key', 'originals/' || user_id || '/' || {uid("job")} || x,
    'timestamp', timestamp, 'ignored', event_type) AS VARCHAR) AS payload FROM fx_messages_base)""")
part("decoded", ["fx_messages"], """
SELECT arrival, value, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j
FROM fx_messages""")
part("fields", ["decoded"], f"""
SELECT arrival, {", ".join(
    f"arg_max(text, place) FILTER (field = '{c}' AND kind = 'VARCHAR') AS {c}" for c in FIELDS)},
  bool_or(kind NOT IN ('VARCHAR', 'NULL')) AS other,
  bool_or(field IN ('job_id', 'user_id') AND kind = 'VARCHAR' AND NOT regexp_matches(text,
    '^[0-9a-f]{{8}}(-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}}$')) AS no_id
FROM (SELECT d.arrival, lower(e.key) AS field, e.type AS kind, e.value ->> '$' AS text, e.id AS place
  FROM decoded d, json_each(d.j) e WHERE lower(e.key) IN {FIELDS}) GROUP BY arrival""")
part("parsed", ["decoded", "fields"], f"""
SELECT arrival, value, coalesce(job_id, '{fixed.NIL_ID}') AS job_id,
  coalesce(user_id, '{fixed.NIL_ID}') AS user_id,
  coalesce(original_filename, '') AS original_filename, coalesce(file_key, '') AS file_key,
  timestamp, CASE WHEN j IS NULL OR other THEN 'json' WHEN no_id THEN 'id' END AS problem
FROM decoded LEFT JOIN fields USING (arrival)""")
part("first_deliveries", ["parsed"], """
SELECT * EXCLUDE (rn, value, problem) FROM (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY arrival) AS rn FROM parsed
  WHERE problem IS NULL) WHERE rn = 1""")
part("intake", ["first_deliveries"], f"""
SELECT * FROM first_deliveries m WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND {uid("o_orderkey")} = m.job_id)""")

# Segmentation of src(doc_id, filename, text); every query names its source.
part("body", ["src"], f"""
SELECT doc_id, filename, {trim(prepared("text", "filename"))} AS body FROM src""")
part("trimmed", ["src"], f"SELECT doc_id, filename, {trim('text')} AS body FROM src")
part("line0", ["text_lines"], f"""
SELECT *, {trim("line")} AS t FROM text_lines""")
part("line1", ["line0"], f"SELECT *, {title('t')} AS title FROM line0")
part("line2", ["line1"], """
SELECT *, lead(t) OVER w AS next_t, lead(title) OVER w AS next_title FROM line1
WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)""")
part("line3", ["line2"], """
SELECT *, coalesce(title IS NOT NULL AND next_title IS NULL AND strlen(next_t) BETWEEN 1 AND 59
  AND NOT ends_with(next_t, '.'), false) AS absorbs FROM line2""")
part("line4", ["line3"], """
SELECT *, coalesce(lag(absorbs) OVER w, false) AS absorbed,
  sum(CASE WHEN title IS NULL THEN 0 ELSE 1 END) OVER
    (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS grp FROM line3
WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)""")
part("h_units", ["line4"], f"""
SELECT doc_id, dense_rank() OVER (PARTITION BY doc_id ORDER BY grp) AS unit_no, heading, subtitle,
  CASE WHEN heading IS NULL THEN 'Capítulo 01' WHEN subtitle IS NULL THEN heading
    ELSE heading || ' - ' || subtitle END AS title, content
FROM (SELECT doc_id, grp, max(title) AS heading, max(CASE WHEN absorbs THEN next_t END) AS subtitle,
  string_agg(line, {NL} ORDER BY line_no) AS content FROM line4 WHERE NOT absorbed
  GROUP BY doc_id, grp)""")
part("para0", ["long_text"], f"""
SELECT doc_id, unnest(string_split(body, {NL} || {NL})) AS raw,
  generate_subscripts(string_split(body, {NL} || {NL}), 1) AS pos FROM long_text""")
part("para", ["para0"], f"""
SELECT doc_id, p, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k
FROM (SELECT doc_id, pos, {trim("raw")} AS p FROM para0) WHERE p <> ''""")
part("chunked", ["para"], """
SELECT doc_id, k, p, CAST(1 AS BIGINT) AS chunk, CAST(strlen(p) AS BIGINT) AS size FROM para
WHERE k = 1
UNION ALL
SELECT n.doc_id, n.k, n.p, CASE WHEN c.size >= 1800 THEN c.chunk + 1 ELSE c.chunk END,
  CASE WHEN c.size >= 1800 THEN 0 ELSE c.size END + strlen(n.p)
FROM chunked c JOIN para n ON n.doc_id = c.doc_id AND n.k = c.k + 1""")
part("cand", ["chunked"], f"""
SELECT *, CASE WHEN strlen(split_part(p, {NL}, 1)) < 60
  THEN nullif(regexp_replace(split_part(p, {NL}, 1), '^# ', ''), '') END AS cand FROM chunked""")
part("l_units", ["cand"], f"""
SELECT doc_id, chunk AS unit_no, title, '# ' || title || {NL} || {NL} || body AS content FROM (
  SELECT doc_id, chunk, string_agg(p, {NL} || {NL} ORDER BY k) AS body,
    coalesce(min_by(cand, k) FILTER (WHERE cand IS NOT NULL), printf('Capítulo %02d', chunk))
      AS title
  FROM cand GROUP BY doc_id, chunk)""")
part("routes", ["body", "h_units", "l_units"], """
SELECT b.*, CASE WHEN h.n > 1 THEN 'headings' WHEN strlen(b.body) > 1500 AND l.n > 1 THEN 'chunks'
  ELSE 'single' END AS route
FROM body b LEFT JOIN (SELECT doc_id, count(*) AS n FROM h_units GROUP BY 1) h USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM l_units GROUP BY 1) l USING (doc_id)""")
part("units", ["routes", "h_units", "l_units"], f"""
SELECT doc_id, route, unit_no, printf('capitulo-%02d.md', unit_no) AS filename, title, content
FROM (SELECT r.doc_id, r.route, h.unit_no, h.title, h.content FROM routes r JOIN h_units h
    USING (doc_id) WHERE route = 'headings'
  UNION ALL SELECT r.doc_id, r.route, l.unit_no, l.title, l.content FROM routes r JOIN l_units l
    USING (doc_id) WHERE route = 'chunks')
UNION ALL
SELECT doc_id, route, 1, 'documento.md', coalesce(nullif({stem("filename")}, ''),
  'Documento Principal'), body FROM routes WHERE route = 'single'""")
part("index_md", ["units", "src"], f"""
SELECT doc_id, concat('# Bundle OKF - Índice de Navegación', {NL}, {NL},
  '## Metadatos del Bundle', {NL}, '- **Identificador de Trabajo:** `', doc_id, '`', {NL},
  '- **Documento Origen:** `', any_value(s.filename), '`', {NL},
  '- **Fecha de Generación:** {fx.GENERATED_AT} UTC', {NL},
  '- **Total de Unidades Lógicas:** ', count(*), {NL}, {NL},
  '## Estructura de Contenidos', {NL}, {NL},
  string_agg(concat(unit_no, '. [', u.title, '](', u.filename, ')', {NL}), '' ORDER BY unit_no))
  AS content
FROM units u JOIN src s USING (doc_id) GROUP BY doc_id""")
part("log_line", ["audit"], """
SELECT *, concat('| ', strftime(created_at, '%H:%M:%S'), ' | ', step, ' | ', status, ' | ', message,
  ' |') AS line FROM audit""")
part("log_ends", ["units", "src", "last_line"], f"""
SELECT u.doc_id, 0 AS section, concat('# Trazabilidad de Conversión - log.md', {NL}, {NL},
  '**ID Trabajo:** `', u.doc_id, '` | **Origen:** `', any_value(s.filename), '`', {NL}, {NL},
  '## Historial de Operaciones', {NL}, {NL},
  '| Marca de Tiempo | Etapa | Estado | Detalle |', {NL},
  '| :--- | :--- | :--- | :--- |', {NL}) AS content
FROM units u JOIN src s USING (doc_id) GROUP BY u.doc_id
UNION ALL
SELECT u.doc_id, 2, concat((SELECT line FROM last_line), {NL},
  '## Resumen de Unidades Detectadas', {NL}, {NL},
  string_agg(concat('- Archivo: `', u.filename, '` | Título: **', u.title, '** | Tamaño: ',
    strlen(u.content), ' bytes', {NL}), '' ORDER BY unit_no), {NL},
  '## Estado de Validaciones', {NL}, '- [x] Estructura mínima OKF verificada', {NL},
  '- [x] Presencia de index.md y log.md comprobada', {NL},
  '- [x] Resolución de hipervínculos del índice validada correctamente', {NL})
FROM units u GROUP BY u.doc_id""")
part("log_md", ["log_ends", "log_line"], f"""
SELECT doc_id, section, CAST(NULL AS VARCHAR) AS created_at, CAST(NULL AS VARCHAR) AS log_id, content FROM log_ends
UNION ALL SELECT job_id, 1, strftime(created_at, '%Y-%m-%d %H:%M:%S'), log_id, line || {NL}
FROM log_line WHERE job_id IN (SELECT doc_id FROM log_ends)""")
part("entries", ["index_md", "log_md", "units"], """
SELECT doc_id AS bundle_id, 'index.md' AS path, 0 AS section, CAST(NULL AS VARCHAR) AS created_at, CAST(NULL AS VARCHAR) AS log_id,
  content, 0 AS ord FROM index_md
UNION ALL SELECT doc_id, 'log.md', section, created_at, log_id, content, 1 FROM log_md
UNION ALL SELECT doc_id, filename, 0, NULL, NULL, content, unit_no + 1 FROM units""")
part("damaged", ["entries"], """
SELECT bundle_id, path, CASE WHEN path = 'index.md' AND v = 5 THEN replace(content, '](', '] (')
  ELSE content END AS content
FROM (SELECT *, CAST(right(bundle_id, 12) AS BIGINT) % 6 AS v FROM entries)
WHERE NOT ((path = 'index.md' AND v IN (1, 3)) OR (path = 'log.md' AND v IN (2, 3))
  OR (path = 'capitulo-02.md' AND v = 4))""")
part("found_links", ["checked"], f"""
SELECT bundle_id, unnest(l) AS target, generate_subscripts(l, 1) AS pos FROM (
  SELECT bundle_id, regexp_extract_all(content, '{LINK}', 1) AS l FROM checked
  WHERE path = 'index.md')""")
part("dead_links", ["found_links", "checked"], """
SELECT * FROM found_links f WHERE NOT EXISTS (
  SELECT 1 FROM checked e WHERE e.bundle_id = f.bundle_id AND e.path = f.target)""")
part("verdicts", ["checked", "found_links", "dead_links"], """
SELECT bundle_id, coalesce(has_index AND has_log AND broken IS NULL, false) AS is_valid,
  has_index AND has_log AND l.n IS NULL AS has_warns,
  CASE WHEN has_index AND has_log THEN coalesce(broken, '') ELSE concat_ws('; ',
    CASE WHEN NOT has_index THEN 'ausencia crítica de ''index.md'' en la raíz del bundle' END,
    CASE WHEN NOT has_log THEN 'ausencia crítica de ''log.md'' en la raíz del bundle' END)
  END AS errors,
  CASE WHEN has_index AND has_log AND l.n IS NULL
    THEN 'el archivo index.md no contiene enlaces a documentos de concepto' ELSE '' END AS warnings
FROM (SELECT bundle_id, bool_or(path = 'index.md') AS has_index, bool_or(path = 'log.md') AS has_log
  FROM checked GROUP BY 1) f
LEFT JOIN (SELECT bundle_id, count(*) AS n FROM found_links GROUP BY 1) l USING (bundle_id)
LEFT JOIN (SELECT bundle_id, string_agg(concat('enlace roto en index.md: el archivo ''', target,
    ''' no existe en el bundle'), '; ' ORDER BY pos) AS broken FROM dead_links GROUP BY 1) d
  USING (bundle_id)""")
part("results", ["asked", "verdicts", "units", "entries"], f"""
SELECT a.job_id, a.user_id, a.original_filename,
  CASE WHEN v.bundle_id IS NULL THEN 'FAILED' WHEN v.is_valid THEN 'COMPLETED' ELSE 'INVALID'
    END AS status,
  CASE WHEN v.is_valid THEN 'bundles/' || a.user_id || '/' || a.job_id || '.zip' ELSE '' END
    AS bundle_key,
  CASE WHEN v.bundle_id IS NULL THEN 'Error descargando archivo original: objeto no encontrado'
    WHEN v.is_valid THEN ''
    ELSE 'Validación de Bundle fallida: [' || replace(v.errors, '; ', ' ') || ']' END
    AS error_message,
  coalesce(u.n, 0) AS units_count, coalesce(v.warnings, '') AS warnings,
  CASE WHEN v.is_valid THEN e.digests END AS digests
FROM asked a LEFT JOIN verdicts v ON v.bundle_id = a.job_id
LEFT JOIN (SELECT doc_id, count(*) AS n FROM units GROUP BY 1) u ON u.doc_id = a.job_id
LEFT JOIN (SELECT bundle_id, string_agg(path || ' ' || md5(content), {NL} ORDER BY ord, section)
  AS digests FROM entries WHERE section <> 1 GROUP BY 1) e ON e.bundle_id = a.job_id""")

# What the open names above stand for, per kind of query.
DOCS = {"src": (["fx_docs"], "SELECT * FROM fx_docs")}
PREPARED = {
    **DOCS,
    "text_lines": (["body"], lines_of("body", "doc_id", "body")),
    "long_text": (["body"], "SELECT doc_id, body FROM body"),
}
HEADINGS = {**DOCS, "text_lines": (["trimmed"], lines_of("trimmed", "doc_id", "body")
                                   + " WHERE body <> ''")}
LONG = {"long_text": (["fx_docs"], "SELECT doc_id, text AS body FROM fx_docs")}
BUNDLES = {
    **PREPARED,
    "src": (["fx_job_docs"], "SELECT * FROM fx_job_docs"),
    "audit": (["fx_logs"], "SELECT * FROM fx_logs"),
    "last_line": ([], "SELECT '' AS line"),
    "checked": (["damaged"], "SELECT * FROM damaged"),
}
CONVERTED = {
    **BUNDLES,
    "asked": (["intake"], "SELECT * FROM intake"),
    "src": (["asked", "fx_stored"],
            "SELECT a.job_id AS doc_id, a.original_filename AS filename, d.text "
            "FROM asked a JOIN fx_stored d USING (file_key)"),
    "last_line": ([], "SELECT concat('| 12:30:45 | PROCESAMIENTO | INFO | Inicio de descarga y "
                      f"parsing del documento en segundo plano. |', {NL}) AS line"),
    "checked": (["entries"], "SELECT * FROM entries"),
}
STREAMED = {
    **CONVERTED,
    "asked": (["first_deliveries"], "SELECT * FROM first_deliveries"),
}


def build(select: str, needs: list[str], open_parts: dict) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        deps = open_parts[name][0] if name in open_parts else NEEDS[name]
        for dep in deps:
            if dep != name:
                visit(dep)
        ordered.append(name)

    for name in needs:
        visit(name)
    sql = lambda n: open_parts[n][1] if n in open_parts else PARTS[n]
    ctes = ",\n".join(f"{n} AS ({sql(n).strip()})" for n in ordered)
    return (f"WITH RECURSIVE {ctes}\n" if ctes else "") + select.strip()


ORACLE: dict[str, str] = {}


def oracle(name: str, needs: list[str], select: str, open_parts: dict | None = None) -> None:
    ORACLE[name] = build(select, needs, open_parts or {})


oracle("scan_documents", ["fx_docs"],
       "SELECT doc_id, filename, md5(text) AS digest, strlen(text) AS bytes FROM fx_docs")
oracle("format_gate", ["fx_uploads"], f"""
SELECT upload_id, filename, ok AS accepted, CASE WHEN ok THEN '' ELSE
  'formato ''' || x || ''' no permitido. Formatos soportados: .md, .txt, .html, .markdown, ' ||
  '.docx, .pdf' END AS reason
FROM (SELECT *, {ext("filename")} AS x, lower({ext("filename")}) IN
  ('.md', '.txt', '.html', '.markdown', '.docx', '.pdf') AS ok FROM fx_uploads)""")
oracle("object_keys", ["fx_jobs"], f"""
SELECT job_id, 'originals/' || user_id || '/' || job_id || {ext("original_filename")}
  AS original_key, 'bundles/' || user_id || '/' || job_id || '.zip' AS bundle_key,
  'bundle_' || left(job_id, 8) || '.zip' AS download_name FROM fx_jobs""")
oracle("filename_parts", ["fx_uploads"], f"""
SELECT upload_id, {ext("filename")} AS extension, {stem("filename")} AS stem FROM fx_uploads""")
oracle("go_trim", ["fx_docs"], f"SELECT doc_id, {trim('text')} AS text FROM fx_docs")
oracle("prepare_text", ["fx_docs"],
       f"SELECT doc_id, {prepared('text', 'filename')} AS text FROM fx_docs")
ALL_LINES = {"text_lines": (["fx_docs"], lines_of("fx_docs", "doc_id", "text"))}
oracle("heading_kind", ["line1"], f"""
SELECT doc_id, line_no, CASE WHEN regexp_matches(t, '{HASH}') THEN 'hash'
  WHEN regexp_matches(t, '{CHAPTER}') THEN 'chapter' ELSE 'numbered' END AS kind, title
FROM line1 WHERE title IS NOT NULL""", ALL_LINES)
oracle("readable_ratio", ["text_lines"], f"""
SELECT doc_id, line_no, {ratio("line")} AS ratio, {kept("line")} AS kept FROM text_lines""",
       {"text_lines": (["fx_raw_docs"], lines_of("fx_raw_docs", "doc_id", "text"))})
oracle("clean_lines", ["fx_docs"], f"SELECT doc_id, {clean('text')} AS text FROM fx_docs")
PRINTABLE = r"regexp_replace(line, '[^\x20-\x7E\n\t\x{C0}-\x{10FFFF}]', '', 'g')"
oracle("printable_only", ["text_lines"],
       f"SELECT doc_id, line_no, {trim(PRINTABLE)} AS line FROM text_lines", ALL_LINES)
oracle("markup_paragraphs", ["fx_raw_docs"], f"""
SELECT doc_id, '# ' || doc_id || {NL} || {NL} || CASE WHEN m <> '' THEN m
  ELSE 'Contenido de texto vacío en el documento Word.' END AS text
FROM (SELECT doc_id, {markup_text(f"({markup('text')})")} AS m FROM fx_raw_docs)""")

oracle("segment_headings", ["h_units"],
       "SELECT doc_id, unit_no, title, content FROM h_units", HEADINGS)
oracle("subtitle_lookahead", ["h_units"], """
SELECT doc_id, unit_no, heading, subtitle, title FROM h_units WHERE heading IS NOT NULL""",
       HEADINGS)
oracle("segment_long", ["l_units"], """
SELECT doc_id, unit_no, printf('capitulo-%02d.md', unit_no) AS filename, title, content
FROM l_units""", LONG)
oracle("segment_documents", ["units"],
       "SELECT doc_id, route, unit_no, filename, title, content FROM units", PREPARED)
oracle("unit_counts", ["units"],
       "SELECT doc_id, route, count(*) AS units_count FROM units GROUP BY 1, 2", PREPARED)
oracle("unit_sizes", ["units"],
       "SELECT doc_id, unit_no, filename, strlen(content) AS content_bytes FROM units", PREPARED)
oracle("unit_filenames", ["text_lines"], """
SELECT doc_id, line_no, printf('capitulo-%02d.md', line_no) AS filename,
  printf('Capítulo %02d', line_no) AS title FROM text_lines""", ALL_LINES)

oracle("bundle_index", ["index_md"], "SELECT doc_id AS job_id, content FROM index_md", BUNDLES)
oracle("log_rows", ["log_line"], "SELECT log_id, job_id, line FROM log_line", BUNDLES)
oracle("bundle_log", ["log_md"],
       "SELECT doc_id AS job_id, section, created_at, log_id, content FROM log_md", BUNDLES)
oracle("bundle_entries", ["entries"],
       "SELECT bundle_id, path, section, created_at, log_id, content FROM entries", BUNDLES)
oracle("index_links", ["found_links"], "SELECT bundle_id, pos, target FROM found_links", BUNDLES)
oracle("broken_links", ["dead_links"], "SELECT bundle_id, pos, target FROM dead_links", BUNDLES)
oracle("validate_bundles", ["verdicts"],
       "SELECT bundle_id, is_valid, has_warns, errors, warnings FROM verdicts", BUNDLES)
oracle("entry_dedup", [], """
SELECT conv_id AS bundle_id, role AS path, turn AS ordinal, text AS content, keep FROM (
  SELECT *, 'last' AS keep, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) AS rn
  FROM conversations
  UNION ALL SELECT *, 'first', row_number() OVER (PARTITION BY conv_id, role ORDER BY turn)
  FROM conversations) WHERE rn = 1""")

oracle("ledger_append", ["fx_uploads"], f"""
SELECT {hashed("upload_id || '|' || user_id")} AS job_id, user_id,
  CASE WHEN ends_with(filename, '.md') THEN 'FAILED' ELSE 'PENDING' END AS status,
  0 AS units_count, CASE WHEN ends_with(filename, '.pdf')
    THEN strftime(created_at, '%Y-%m-%d %H:%M:%S') ELSE '{fx.GENERATED_AT}' END AS created_at,
  '{fx.GENERATED_AT}' AS updated_at FROM fx_uploads""")
oracle("job_lookup", ["fx_jobs", "fx_requests"], """
SELECT j.job_id IS NOT NULL AS found, k.job_id, user_id, original_filename, file_key,
  CASE WHEN j.job_id IS NOT NULL THEN coalesce(bundle_key, '') END AS bundle_key, status,
  CASE WHEN j.job_id IS NOT NULL THEN coalesce(error_message, '') END AS error_message,
  units_count, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
  strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM (SELECT DISTINCT job_id FROM fx_requests) k LEFT JOIN fx_jobs j ON j.job_id = k.job_id""")
oracle("user_jobs", ["fx_jobs", "fx_users"], f"""
SELECT {JOB_COLUMNS} FROM fx_jobs WHERE user_id IN (SELECT user_id FROM fx_users)""")
oracle("job_logs", ["fx_logs", "fx_jobs"], """
SELECT log_id, job_id, step, status, message,
  strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM fx_logs
WHERE job_id IN (SELECT job_id FROM fx_jobs)""")
oracle("row_isolation", ["fx_jobs", "fx_requests"], f"""
SELECT request_id, {JOB_COLUMNS} FROM fx_jobs JOIN fx_requests USING (job_id, user_id)""")
oracle("download_gate", ["fx_jobs", "fx_requests"], """
SELECT request_id, job_id, user_id, reason = '' AS allowed, reason,
  CASE WHEN reason = '' THEN bundle_key ELSE '' END AS bundle_key,
  CASE WHEN reason = '' THEN 'bundle_' || left(job_id, 8) || '.zip' ELSE '' END AS download_name
FROM (SELECT r.*, j.bundle_key, CASE WHEN j.job_id IS NULL THEN 'trabajo no encontrado'
    WHEN j.user_id <> r.user_id THEN 'acceso denegado: no es propietario de este recurso'
    WHEN j.status <> 'COMPLETED'
      THEN 'el bundle no está disponible para descarga (estado: ' || j.status || ')'
    WHEN coalesce(j.bundle_key, '') = '' THEN 'referencia de bundle no encontrada'
    ELSE '' END AS reason
  FROM fx_requests r LEFT JOIN fx_jobs j ON j.job_id = r.job_id)""")
oracle("jobs_report", ["fx_jobs"], """
SELECT left(job_id, 8) || '...' AS short_id, original_filename,
  CASE status WHEN 'PENDING' THEN 'PENDING (En Cola)'
    WHEN 'PROCESSING' THEN 'PROCESSING (Convertiendo)'
    WHEN 'COMPLETED' THEN 'COMPLETED (Válido)' WHEN 'FAILED' THEN 'FAILED (Error)'
    WHEN 'INVALID' THEN 'INVALID (Rechazado)' ELSE status END AS state,
  coalesce(units_count, 0) || ' u.' AS units, strftime(created_at, '%H:%M:%S') AS clock,
  status = 'COMPLETED' AS downloadable FROM fx_jobs""")
for name, page in (("jobs_page", 2), ("jobs_last_page", 1_000_000)):
    oracle(name, ["fx_jobs"], f"""
SELECT user_id, job_id, position, page, total_pages, total_jobs FROM (
  SELECT *, least({page}, total_pages) AS page FROM (
    SELECT user_id, job_id, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, job_id)
      AS position, count(*) OVER (PARTITION BY user_id) AS total_jobs,
      CAST(ceil(count(*) OVER (PARTITION BY user_id) / 5.0) AS BIGINT) AS total_pages FROM fx_jobs))
WHERE position > (page - 1) * 5 AND position <= page * 5""")
oracle("job_trace", ["fx_jobs", "fx_logs"], """
SELECT j.job_id, j.status, log_id, step, l.status AS log_status, message,
  strftime(l.created_at, '%Y-%m-%d %H:%M:%S') AS logged_at
FROM fx_jobs j LEFT JOIN fx_logs l ON l.job_id = j.job_id""")
oracle("register_unique", ["fx_registrations", "fx_users"], """
SELECT user_id, email, arrival FROM (
  SELECT *, row_number() OVER (PARTITION BY email ORDER BY arrival, user_id) AS rn
  FROM fx_registrations) WHERE rn = 1 AND email NOT IN (SELECT email FROM fx_users)""")
oracle("cascade_delete", ["gone", "fx_logs"], """
SELECT 'job' AS kind, job_id AS id FROM fx_jobs WHERE job_id NOT IN (SELECT job_id FROM gone)
UNION ALL SELECT 'log', log_id FROM fx_logs WHERE job_id NOT IN (SELECT job_id FROM gone)
UNION ALL SELECT 'removed object', file_key FROM gone WHERE file_key <> ''
UNION ALL SELECT 'removed object', bundle_key FROM gone WHERE bundle_key <> ''""",
       {"gone": (["fx_jobs", "fx_deletes"],
                 "SELECT * FROM fx_jobs j WHERE EXISTS (SELECT 1 FROM fx_deletes d "
                 "WHERE d.job_id = j.job_id AND d.user_id = j.user_id)")})
ANSWERS = """
SELECT request_id, r.job_id, r.user_id, CASE WHEN j.job_id IS NULL THEN 'trabajo no encontrado'
  WHEN j.user_id <> r.user_id THEN 'acceso denegado: no es propietario de este recurso'
  ELSE '' END AS reason
FROM fx_requests r LEFT JOIN fx_jobs j ON j.job_id = r.job_id"""
oracle("delete_gate", ["fx_requests", "fx_jobs"], f"""
SELECT request_id, job_id, user_id, reason = '' AS allowed, reason FROM ({ANSWERS})""")
oracle("trace_gate", ["fx_requests", "fx_jobs", "fx_logs"], f"""
SELECT request_id, a.job_id, user_id, reason = '' AS allowed, reason, log_id, step,
  l.status AS log_status
FROM ({ANSWERS}) a LEFT JOIN fx_logs l ON a.reason = '' AND l.job_id = a.job_id""")
oracle("published_entries", ["entries", "fx_jobs", "fx_deletes"], """
SELECT bundle_id, path, section, log_id, content FROM entries WHERE bundle_id NOT IN (
  SELECT j.job_id FROM fx_jobs j JOIN fx_deletes d ON d.job_id = j.job_id
  AND d.user_id = j.user_id)""", BUNDLES)
oracle("current_jobs", ["fx_jobs", "fx_states"], f"""
SELECT j.job_id, user_id, original_filename, file_key,
  CASE WHEN s.status = 'COMPLETED' THEN 'bundles/' || event_id ELSE '' END AS bundle_key,
  coalesce(s.status, CASE WHEN n % 17 = 0 THEN 'FAILED' ELSE 'PENDING' END) AS status,
  CASE WHEN s.status = 'FAILED' THEN 'error ' || event_id
    WHEN s.status IS NULL AND n % 17 = 0 THEN 'Error al publicar trabajo en la cola de mensajes'
    ELSE '' END AS error_message,
  coalesce(event_id % 9, 0) AS units_count,
  strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
  strftime(coalesce({GENERATED} + to_seconds(event_id), created_at), '%Y-%m-%d %H:%M:%S')
    AS updated_at
FROM fx_jobs j LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY seq DESC) AS rn FROM fx_states) s
  ON s.job_id = j.job_id AND rn = 1""")
oracle("fk_orphans", ["fx_jobs", "fx_logs", "fx_users"], """
SELECT 'job' AS kind, job_id AS id FROM fx_jobs WHERE user_id NOT IN (
  SELECT user_id FROM fx_users WHERE CAST(right(user_id, 12) AS BIGINT) % 17 <> 0)
UNION ALL SELECT 'log', log_id FROM fx_logs WHERE job_id NOT IN (
  SELECT job_id FROM fx_jobs WHERE n % 17 <> 0)""")
oracle("latest_status", ["fx_states"], """
SELECT job_id, seq, status,
  CASE WHEN status = 'COMPLETED' THEN 'bundles/' || event_id ELSE '' END AS bundle_key,
  CASE WHEN status = 'FAILED' THEN 'error ' || event_id ELSE '' END AS error_message,
  event_id % 9 AS units_count
FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY seq DESC) AS rn FROM fx_states)
WHERE rn = 1""")
oracle("status_transitions", ["fx_states"], """
SELECT job_id, seq, status, previous, coalesce(
  (previous IS NULL AND status = 'PENDING')
  OR (status = 'PROCESSING' AND previous <> 'COMPLETED')
  OR (status = 'FAILED' AND previous = 'PENDING')
  OR (status IN ('COMPLETED', 'FAILED', 'INVALID') AND previous = 'PROCESSING'), false) AS legal
FROM (SELECT *, lag(status) OVER (PARTITION BY job_id ORDER BY seq) AS previous FROM fx_states)""")

ALLOWED = "('.md', '.txt', '.html', '.markdown', '.docx', '.pdf')"
oracle("accept_jobs", ["up"], f"""
SELECT 'job' AS kind, job_id AS id, concat_ws('|', user_id, filename, file_key, 'PENDING') AS detail
FROM up WHERE ok
UNION ALL SELECT 'log', {hashed("job_id || '|RECEPCION'")}, concat_ws('|', job_id, 'RECEPCION',
  'INFO', 'Documento ''' || filename ||
  ''' recibido correctamente. Trabajo registrado en estado PENDING.') FROM up WHERE ok
UNION ALL SELECT 'message', job_id, CAST(json_object('job_id', job_id, 'user_id', user_id,
  'original_filename', filename, 'file_key', file_key,
  'timestamp', strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ')) AS VARCHAR) FROM up WHERE ok
UNION ALL SELECT 'rejected', upload_id, 'formato ''' || x ||
  ''' no permitido. Formatos soportados: .md, .txt, .html, .markdown, .docx, .pdf'
FROM up WHERE NOT ok""",
       {"up": (["fx_uploads"], f"""
SELECT *, 'originals/' || user_id || '/' || job_id || x AS file_key FROM (
  SELECT *, {ext("filename")} AS x, lower({ext("filename")}) IN {ALLOWED} AS ok,
    {hashed("upload_id || '|' || user_id")} AS job_id FROM fx_uploads)""")})
MESSAGE = """CAST(json_object('job_id', job_id, 'user_id', user_id,
  'original_filename', original_filename, 'file_key', file_key,
  'timestamp', strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ')) AS VARCHAR)"""
oracle("publish_messages", ["fx_jobs"], f"SELECT job_id, {MESSAGE} AS value FROM fx_jobs")
oracle("json_roundtrip", ["fx_jobs"], """
SELECT job_id, user_id, original_filename, file_key,
  strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, CAST(NULL AS VARCHAR) AS problem
FROM fx_jobs""")
oracle("dead_letters", ["parsed"],
       "SELECT arrival, value, problem FROM parsed WHERE problem IS NOT NULL")
oracle("idempotent_intake", ["intake"], """
SELECT job_id, arrival, user_id, original_filename, file_key, timestamp FROM intake""")
oracle("convert_corpus", ["results"], "SELECT * FROM results", CONVERTED)
oracle("audit_rows", ["rows"], f"""
SELECT {hashed(f"concat_ws('|', job_id, {fx.BATCH_ID}, step)")} AS log_id, job_id, step, status,
  message, '{fx.GENERATED_AT}' AS created_at FROM rows""",
       {**CONVERTED, "rows": (["results"], """
SELECT job_id, 'PROCESAMIENTO' AS step, 'INFO' AS status,
  'Inicio de descarga y parsing del documento en segundo plano.' AS message FROM results
UNION ALL SELECT job_id, 'VALIDACION', 'ERROR', error_message FROM results WHERE status = 'INVALID'
UNION ALL SELECT job_id, 'PUBLICACION', 'SUCCESS', concat('Bundle OKF validado exitosamente con ',
  units_count, ' unidades. Publicado en ', bundle_key) FROM results WHERE status = 'COMPLETED'""")})
oracle("stream_ingest", ["results"], """
SELECT job_id, status, bundle_key, error_message, units_count FROM results""", STREAMED)

part("sliced", ["fx_messages"], f"""
SELECT CAST(ceil((max(arrival) // 5 + 1) / greatest({fx.FILES},
  ceil(count(*) / {fx.MESSAGES_A_FILE}.0))) AS BIGINT) AS jobs FROM fx_messages""")
part("in_batches", ["parsed", "sliced"], f"""
SELECT p.*, CAST(arrival // 5 // jobs // {fx.FILES_A_BATCH} AS BIGINT) AS batch_id
FROM parsed p, sliced""")
part("batch_counts", ["in_batches"], """
SELECT batch_id, count(*) AS messages, count(problem) AS dead_letters,
  count(DISTINCT CASE WHEN problem IS NULL THEN job_id END) AS deliveries
FROM in_batches GROUP BY 1""")
# Jobs lie in one batch each, but for the one without an id, whose document never exists.
part("batch_states", ["in_batches", "results"], """
SELECT batch_id, count_if(status = 'COMPLETED') AS completed, count_if(status = 'INVALID') AS invalid,
  count_if(status = 'FAILED') AS failed
FROM (SELECT DISTINCT batch_id, job_id FROM in_batches WHERE problem IS NULL)
JOIN results USING (job_id) GROUP BY 1""")
oracle("progress_rows", ["batch_counts", "batch_states"], """
SELECT batch_id, messages, dead_letters, deliveries, CAST(0 AS BIGINT) AS skipped,
  CAST(completed AS BIGINT) AS completed, CAST(invalid AS BIGINT) AS invalid,
  CAST(failed AS BIGINT) AS failed
FROM batch_counts JOIN batch_states USING (batch_id)""", STREAMED)
oracle("stream_replay", ["batch_counts", "in_batches"], """
SELECT batch_id, 'dead_letters' AS table_name, dead_letters AS rows FROM batch_counts
UNION ALL SELECT batch_id, unnest(['deliveries', 'intake', 'results']), deliveries FROM batch_counts
UNION ALL SELECT batch_id, 'batches', 1 FROM batch_counts
UNION ALL SELECT batch_id, 'states', count(*) FROM (
  SELECT job_id, max(batch_id) AS batch_id FROM in_batches WHERE problem IS NULL GROUP BY 1)
GROUP BY 1""", STREAMED)
oracle("bundle_store", ["results", "entries"], """
SELECT bundle_id, path, section, md5(concat(content,
  CASE WHEN CAST(right(bundle_id, 12) AS BIGINT) % 5 = 0 THEN 'again' ELSE '' END)) AS digest
FROM entries JOIN results ON job_id = bundle_id WHERE status = 'COMPLETED' AND section <> 1""", CONVERTED)
oracle("scan_files", ["fx_stored", "parsed"], f"""
SELECT file_key, regexp_extract(file_key, '([^/]*)$', 1) AS filename, md5(text) AS digest,
  strlen(text) AS bytes FROM fx_stored WHERE file_key IN (
  SELECT file_key FROM parsed WHERE problem IS NULL)""")
