"""Dictionaries, label domains and prompt wording.

Results depend on these exact values, so they are written out plainly.
"""

# Topic keywords in order of precedence, keyword -> category.
CATEGORY_KEYWORDS = {
    "infrastruktur": "Infrastruktur",
    "jalan": "Infrastruktur",
    "jembatan": "Infrastruktur",
    "sosial": "Sosial",
    "bansos": "Sosial",
    "kemiskinan": "Sosial",
    "pendidikan": "Pendidikan",
    "sekolah": "Pendidikan",
    "kesehatan": "Kesehatan",
    "rs": "Kesehatan",
    "puskesmas": "Kesehatan",
    "lingkungan": "Lingkungan",
    "sampah": "Lingkungan",
    "banjir": "Lingkungan",
    "administrasi": "Administrasi",
    "perizinan": "Administrasi",
    "ktp": "Administrasi",
    "lainnya": "Lainnya",
}
OTHER_CATEGORY = "Lainnya"

# Abbreviations and slang -> full word.
SLANG = {
    "yg": "yang", "dgn": "dengan", "utk": "untuk", "krn": "karena",
    "tdk": "tidak", "sdh": "sudah", "blm": "belum",
    "bgt": "banget", "jg": "juga", "sy": "saya", "hrs": "harus",
    "tsb": "tersebut", "svp": "tolong", "mhn": "mohon", "thx": "terima kasih",
    "info": "informasi", "tlg": "tolong", "kpd": "kepada", "bpk": "bapak",
    "ibu": "ibu", "jl": "jalan", "jln": "jalan", "gg": "gang", "rt": "rt",
    "rw": "rw", "kel": "kelurahan", "kec": "kecamatan", "kab": "kabupaten",
    "pls": "tolong", "asap": "segera", "udh": "sudah", "gak": "tidak",
    "ga": "tidak", "nggak": "tidak", "emg": "memang", "klo": "kalau",
    "kalo": "kalau", "gimana": "bagaimana", "aja": "saja", "doang": "saja",
}
SLANG_EDGE_PUNCTUATION = ".,!?;:()"

# Personal-data tags and landline area codes.
PII_TAGS = ("NIK", "PHONE", "EMAIL", "REKENING")
AREA_CODES = (
    "021", "022", "0231", "0251", "0265", "024", "0271", "0274", "0281", "031",
    "0341", "0361", "0370", "0380", "061", "0651", "0711", "0721", "0751", "0761",
    "0778", "0511", "0542", "0561", "0411", "0431", "0911", "0967",
)

# Label domains of the first label schema.
INTENTS = ("complaint", "question", "suggestion", "report")
CATEGORIES = (
    "Infrastruktur", "Sosial", "Pendidikan", "Kesehatan",
    "Lingkungan", "Administrasi", "Lainnya",
)
URGENCIES = ("low", "medium", "high")
SENTIMENTS = ("positif", "netral", "negatif")
MISSING_LOCATION_WORDS = ("null", "none", "-", "")

# Mapping from the first label schema to the second.
INTENT_V2 = {
    "complaint": "complaint",
    "report": "complaint",
    "question": "non-complaint",
    "suggestion": "non-complaint",
}
CATEGORY_V2 = {
    "Infrastruktur": "infrastruktur",
    "Sosial": "lainnya",
    "Pendidikan": "lainnya",
    "Kesehatan": "lainnya",
    "Lingkungan": "kebersihan",
    "Administrasi": "kependudukan",
    "Lainnya": "lainnya",
    "infrastruktur": "infrastruktur",
    "sosial": "lainnya",
    "pendidikan": "lainnya",
    "kesehatan": "lainnya",
    "lingkungan": "kebersihan",
    "administrasi": "kependudukan",
    "lainnya": "lainnya",
}
SENTIMENT_V2 = {
    "positif": "positive",
    "netral": "neutral",
    "negatif": "negative",
    "positive": "positive",
    "neutral": "neutral",
    "negative": "negative",
}

# Prompt and instruction wording. {name} marks a column, {{ }} a brace.
INPUT_TEMPLATE = "Judul: {judul}\nLaporan: {isi}"

URGENCY_PROMPT = """\
Kamu adalah sistem klasifikasi laporan pengaduan masyarakat Indonesia.
Tugasmu: tentukan tingkat urgensi laporan berikut.

Definisi:
- high   : mengancam keselamatan jiwa, darurat, atau sudah berlangsung lama dan berdampak luas
- medium : mengganggu aktivitas warga, perlu segera tapi tidak darurat
- low    : pertanyaan umum, saran, atau masalah ringan

Laporan:
Judul: {judul}
Isi: {isi}

Jawab HANYA dengan satu kata: high, medium, atau low.
Jangan tambahkan penjelasan apapun."""
URGENCY_PROMPT_LIMITS = {"judul": 300, "isi": 600}

FULL_LABEL_SYSTEM = (
    "Kamu adalah sistem ekstraksi informasi laporan pengaduan masyarakat Indonesia. "
    "Jawab HANYA dengan JSON valid, tanpa penjelasan, tanpa markdown, tanpa backtick."
)
FULL_LABEL_PROMPT = """\
Ekstrak informasi dari laporan pengaduan berikut. Jawab HANYA JSON, tidak ada teks lain.

Laporan:
Judul: {judul}
Isi: {isi}

Format JSON yang harus dikembalikan:
{{
  "intent": "complaint|question|suggestion|report",
  "kategori": "Infrastruktur|Sosial|Pendidikan|Kesehatan|Lingkungan|Administrasi|Lainnya",
  "location": "lokasi spesifik atau null",
  "object": "objek atau masalah utama yang dilaporkan",
  "urgency": "low|medium|high",
  "sentiment": "positif|netral|negatif",
  "summary": "ringkasan 1 kalimat maksimal 20 kata"
}}

Definisi urgency:
- high   : darurat, mengancam keselamatan, atau sudah lama tidak ditangani
- medium : mengganggu aktivitas, perlu ditangani tapi tidak darurat  
- low    : pertanyaan, saran, atau masalah ringan

Jawab hanya JSON:"""
FULL_LABEL_PROMPT_LIMITS = {"judul": 300, "isi": 700}

INTAKE_PROMPT = '''\
Kamu adalah sistem klasifikasi pengaduan masyarakat Kota Surabaya.
Analisis teks pengaduan berikut dan kembalikan hasil dalam format JSON.

Teks pengaduan:
"""{text}"""

Kembalikan HANYA JSON berikut tanpa penjelasan tambahan:
{{
  "intent": "<complaint | non-complaint>",
  "category": "<infrastruktur | kependudukan | perizinan | kebersihan | keamanan | lainnya>",
  "location": "<lokasi yang disebutkan, atau null>",
  "object": "<objek masalah utama>",
  "urgency": "<low | medium | high>",
  "sentiment": "<positive | neutral | negative>",
  "summary": "<ringkasan 1 kalimat dalam Bahasa Indonesia>"
}}'''

FINETUNE_SYSTEM = (
    "Kamu adalah sistem klasifikasi laporan pengaduan masyarakat Indonesia. "
    "Ekstrak informasi berikut dari laporan:\n"
    "- intent: jenis pengaduan (complaint / question / suggestion / report)\n"
    "- kategori: bidang laporan\n"
    "- location: lokasi spesifik yang disebutkan (atau null)\n"
    "- object: objek/masalah utama yang dilaporkan\n"
    "- urgency: tingkat urgensi (low / medium / high)\n"
    "- sentiment: sentimen pelapor (positif / netral / negatif)\n"
    "- summary: ringkasan singkat 1 kalimat\n\n"
    "Jawab dalam format JSON saja."
)
TRAINING_INSTRUCTION = (
    "Kamu adalah sistem klasifikasi laporan pengaduan masyarakat Indonesia. "
    "Ekstrak informasi berikut dari laporan: intent, kategori, location, object, urgency, "
    "sentiment, dan summary. "
    "Jawab dalam format JSON."
)

# Where the complaint site keeps each field, and its list cards.
DETAIL_RULES = {
    "id": {"tag": "p", "contains": "Tracking ID", "inner": "b"},
    "judul": {"tag": "h1", "css_class": "complaint-title"},
    "isi": {"tag": "div", "css_class": "complaint-excerpt", "prefer": "p"},
    "kategori": {"tag": "a", "href_contains": "/laporan/kategori/"},
}
LIST_CARD = {"tag": "div", "css_classes": ("post-title", "h4", "mg-0")}

# Numeric defaults.
MIN_BODY_LENGTH = 20
DUPLICATE_THRESHOLD = 0.6
EMPTY_PAGES_TO_STOP = 3
MODEL_RETRIES = 2
