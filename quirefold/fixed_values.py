"""Results are only right when these equal the values of the system being matched.

Everything here is data (names, limits, patterns, addresses of the documents' publisher), no logic.
Patterns are written in Java regex syntax: ``(?iu)`` folds case for accented letters, ``(?U)`` makes
``\\s \\d \\b`` Unicode-aware and ``(?d)`` lets only LF end a line.
"""

# --- document kinds, in listing order -------------------------------------------------------------
DOC_TYPES = ("ata", "comunicado")
TITLE_PREFIXES = {"ata": "Ata", "comunicado": "Comunicado"}
# Which spelling of the meeting number wins, per kind.
NUMBER_FIELDS = {"ata": ("nroReuniao", "nro_reuniao"), "comunicado": ("nro_reuniao", "nroReuniao")}
HTML_FIELDS = {"ata": "textoAta", "comunicado": "textoComunicado"}

# --- addresses stored in documents.url ------------------------------------------------------------
BASE_URL = "https://www.bcb.gov.br"
DETAIL_URLS = {
    "ata": BASE_URL + "/api/servico/sitebcb/copom/atas_detalhes?nro_reuniao=",
    "comunicado": BASE_URL + "/api/servico/sitebcb/copom/comunicados_detalhes?nro_reuniao=",
}

# --- limits and defaults --------------------------------------------------------------------------
MAX_TEXT_BYTES = 10 * 1024 * 1024
MAX_CHUNKS_PER_DOC = 1000
CHUNK_SIZE = 500
CHUNK_OVERLAP = 20
MIN_RATIO = 0.5
CHUNK_STRATEGY = "recursive"
EMBED_BATCH = 50
EMBED_DIMS = 1536
TOP_K = 5
RUN_INTERVAL = 20
PREVIEW_CHARS = 200
SEARCH_PREVIEW_CHARS = 300
TITLE_CHARS = 50

# --- text cleaning --------------------------------------------------------------------------------
INVISIBLE_CHARS = "\u00ad\u200b\u200c\u200d\ufeff"
LIGATURES = {
    "\ufb00": "ff",
    "\ufb01": "fi",
    "\ufb02": "fl",
    "\ufb03": "ffi",
    "\ufb04": "ffl",
    "\ufb05": "st",
    "\ufb06": "st",
}
BOILERPLATE_PATTERNS = (
    r"(?iuU)Banco Central do Brasil[\s\x1c-\x1f]*\n",
    r"(?iuU)Copom[\s\x1c-\x1f]*[-–][\s\x1c-\x1f]*\d+[ªa]?[\s\x1c-\x1f]*Reunião[\s\x1c-\x1f]*\n",
    r"(?iuU)Ata da?[\s\x1c-\x1f]+\d+[ªa]?[\s\x1c-\x1f]+Reunião do Copom[\s\x1c-\x1f]*\n",
    r"(?iuU)\bwww\.bcb\.gov\.br\b[\s\x1c-\x1f]*\n",
    r"(?iuU)Página \d+ de \d+[\s\x1c-\x1f]*\n",
    # Lone page numbers. White space at a line start that leads to none is taken as it is, in one step, so that a run of
    # line feeds is read once; a pair is a pattern and what replaces it.
    (r"(?mUd)^(?:[\s\x1c-\x1f]*+\d+[\s\x1c-\x1f]*$|([\s\x1c-\x1f]++))", "$1"),
)

# What a pattern cannot match without, in lower case.
BOILERPLATE_WORDS = dict(zip(BOILERPLATE_PATTERNS, ("banco central do brasil", "copom", "reunião do copom", "www.bcb.gov.br", "página ")))

# --- HTML to text ---------------------------------------------------------------------------------
HTML_DROPPED_BLOCKS = r"(?isu)<(script|style)[^>]*>.*?</\1>"
HTML_LINE_BREAKS = r"(?iu)<(br|p|div|h[1-6]|li|tr)[^>]*>"
HTML_TAGS = r"<[^>]+>"
