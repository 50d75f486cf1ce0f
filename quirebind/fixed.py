"""Fixed values.

Everything here must equal what existing users see: texts, word lists, limits
and formats of the bundles, the ledger and the reports.  Operators take the
limits as parameters with these defaults.
"""

import string

# --- fixed values: white space (trimming) ----------------------------------
WHITE = "\t\n\x0b\f\r \x85\xa0" + "".join(
    map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

# --- fixed values: intake ---------------------------------------------------
ALLOWED_EXTENSIONS = [".md", ".txt", ".html", ".markdown", ".docx", ".pdf"]
REJECTED_FORMAT = (
    "formato '%s' no permitido. Formatos soportados: .md, .txt, .html, .markdown, .docx, .pdf"
)
NIL_ID = "00000000-0000-0000-0000-000000000000"

# --- fixed values: headings -------------------------------------------------
CHAPTER_WORDS = ["chapter", "capítulo", "capitulo", "sección", "seccion", "parte"]
ROMAN_LETTERS = "IVXLCDM"
HEADING_CAPITALS = "A-ZÁÉÍÓÚÑ"
NUMBERED_TITLE_RUNES = (2, 60)
CHAPTER_TITLE = "Capítulo "
SECTION_TITLE = "Sección "

# --- fixed values: segmentation ---------------------------------------------
TITLE_BYTES = 60
LONG_DOCUMENT_BYTES = 1500
CHUNK_BYTES = 1800
UNIT_FILE = "capitulo-%s.md"
UNTITLED_UNIT = "Capítulo %s"
SINGLE_FILE = "documento.md"
SINGLE_TITLE = "Documento Principal"

# --- fixed values: text cleaning --------------------------------------------
READABLE_RUNES = string.ascii_letters + string.digits + " .,:;-()" + "áéíóúñÁÉÍÓÚÑ"
# All below U+00C0 but tab, newline and printable ASCII.
DROPPED_RUNES = "".join(
    c for c in map(chr, range(192)) if c not in "\t\n" and not " " <= c <= "~"
)
READABLE_SHARE = 0.70
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}
EMPTY_MARKUP = "Contenido de texto vacío en el documento Word."
EMPTY_SCAN = (
    "*Nota: El archivo PDF procesado no contiene texto seleccionable o es una imagen escaneada.*"
)

# --- fixed values: bundle files ---------------------------------------------
INDEX_FILE = "index.md"
LOG_FILE = "log.md"
INDEX_HEAD = "# Bundle OKF - Índice de Navegación\n\n## Metadatos del Bundle\n"
INDEX_JOB = "- **Identificador de Trabajo:** `%s`\n"
INDEX_SOURCE = "- **Documento Origen:** `%s`\n"
INDEX_TIME = "- **Fecha de Generación:** %s\n"
INDEX_COUNT = "- **Total de Unidades Lógicas:** %s\n\n"
INDEX_CONTENTS = "## Estructura de Contenidos\n\n"
INDEX_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"
LOG_HEAD = "# Trazabilidad de Conversión - log.md\n\n"
LOG_JOB = "**ID Trabajo:** `%s` | **Origen:** `%s`\n\n"
LOG_HISTORY = (
    "## Historial de Operaciones\n\n"
    "| Marca de Tiempo | Etapa | Estado | Detalle |\n"
    "| :--- | :--- | :--- | :--- |\n"
)
LOG_UNITS = "\n## Resumen de Unidades Detectadas\n\n"
LOG_UNIT = "- Archivo: `%s` | Título: **%s** | Tamaño: %s bytes\n"
LOG_CHECKS = (
    "\n## Estado de Validaciones\n"
    "- [x] Estructura mínima OKF verificada\n"
    "- [x] Presencia de index.md y log.md comprobada\n"
    "- [x] Resolución de hipervínculos del índice validada correctamente\n"
)
LOG_TIME_FORMAT = "HH:mm:ss"

# --- fixed values: validation -----------------------------------------------
LINK_PATTERN = r"\[[^\n]*?\]\(([^\n]*?\.md)\)"
NO_INDEX = "ausencia crítica de 'index.md' en la raíz del bundle"
NO_LOG = "ausencia crítica de 'log.md' en la raíz del bundle"
NO_LINKS = "el archivo index.md no contiene enlaces a documentos de concepto"
BROKEN_LINK = "enlace roto en index.md: el archivo '%s' no existe en el bundle"

# --- fixed values: job states, audit steps, messages ------------------------
PENDING, PROCESSING, COMPLETED, FAILED, INVALID = (
    "PENDING", "PROCESSING", "COMPLETED", "FAILED", "INVALID",
)
STATES = [PENDING, PROCESSING, COMPLETED, FAILED, INVALID]
RECEIVED_STEP = ("RECEPCION", "INFO")
RECEIVED_MESSAGE = (
    "Documento '%s' recibido correctamente. Trabajo registrado en estado PENDING."
)
STARTED_STEP = ("PROCESAMIENTO", "INFO")
STARTED_MESSAGE = "Inicio de descarga y parsing del documento en segundo plano."
REFUSED_STEP = ("VALIDACION", "ERROR")
REFUSED_MESSAGE = "Validación de Bundle fallida: [%s]"
PUBLISHED_STEP = ("PUBLICACION", "SUCCESS")
PUBLISHED_MESSAGE = "Bundle OKF validado exitosamente con %s unidades. Publicado en %s"
MISSING_DOCUMENT = "Error descargando archivo original: objeto no encontrado"

# --- fixed values: access answers and reports -------------------------------
NOT_FOUND = "trabajo no encontrado"
PUBLISH_FAILED = "Error al publicar trabajo en la cola de mensajes"
NOT_OWNER = "acceso denegado: no es propietario de este recurso"
NOT_READY = "el bundle no está disponible para descarga (estado: %s)"
NO_BUNDLE = "referencia de bundle no encontrada"
STATE_LABELS = {
    "PENDING": "PENDING (En Cola)",
    "PROCESSING": "PROCESSING (Convertiendo)",
    "COMPLETED": "COMPLETED (Válido)",
    "FAILED": "FAILED (Error)",
    "INVALID": "INVALID (Rechazado)",
}
PAGE_SIZE = 5
