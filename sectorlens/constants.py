"""Fixed values that must equal the reference's for identical results.

Stated plainly, in their original order.
"""

# --- Fixed values: words deleted from a company name before a web search.
NAME_STOP_WORDS = ["aktiebolag", "handelsbolag"]

# --- Fixed values: search-result domains never accepted as a company url.
URL_BLACKLIST = [
    "allabolag.se", "facebook.com", "facebook.se", "linkedin.com", "kompass.com",
    "apple.com", "orebro.se", "worldsbiggestcompanies.com", "kreditrapporten.se",
    "utsidan.se", "lansstyrelsen.se", "barometern.se", "betyg.se", "instagram.com",
    "tripadvisor.com", "livsmedelsverket.se", "youtube.com", "118100.se", "twitter.com",
    "systembolaget.se", "riksarkivet.se", "pubmed.ncbi.nlm.nih.gov", "alltombolag.se",
    "yelp.com", "eniro.se", "wiktionary.org", "kth.se", "wikipedia.org", "pintrest.com",
    "primevideo.com",
]

# --- Fixed values: url-path stop tokens of the crawler. "agarekronika" is one
# token in the reference (two words fused by a missing separator); the clean
# mode uses "agare" and "kronika" instead.
URL_STOP_TOKENS = [
    "/en/", "/en-US", "/en-GB", "lang=en", "in-english", ".pdf", ".jpg", ".png",
    ".jpeg", ".gif", ".svg", ".doc", ".docx", ".ppt", ".pptx",
    "cookie-", "cookies", "integritet", "privacy", "policy", "terms",
    "conditions", "contact", "job", "career", "press", "news",
    "investor", "investors", "kontakt", "kontakta", "karriär", "jobb",
    "styrelse", "nyhet", "medlemmar", "personal", "ledning",
    "hallbarhet", "sustainability", "miljo", "environment",
    "lediga-tjanster", "lediga-jobb", "management", "people",
    "visselblasning", "socialamedier", "social-media", "instagram",
    "sociala-medier", "facebook", "twitter", "linkedin", "youtube",
    "hitta", "find", "omsorg", "riktlinjer", "stadga", "agarekronika",
    "partner", "partners", "sponsring", "sponsorship",
    "diversity", "mangfald", "equality", "jämställdhet",
    "organisation", "organization", "om-webbplats", "about-website",
    "tillganglighet", "accessibility", "agare", "karriar",
    "/bg-bg", "/cs-cz", "/da-dk", "/de-de", "/el-gr", "/es-es", "/et-ee",
    "/fi-fi", "/fr-fr", "/hr-hr", "/hu-hu", "/it-it", "/lt-lt", "/lv-lv",
    "/mt-mt", "/nl-nl", "/pl-pl", "/pt-pt", "/ro-ro", "/sk-sk", "/sl-sl",
    "ja-jp", "ko-kr", "zh-cn", "zh-tw", "ar-ae", "he-il", "hi-in", "th-th",
    "tr-tr", "vi-vn", "ru-ru", "uk-ua", "sr-rs", "bs-ba", "mk-mk", "sq-al",
    "aterforsaljare", "bolagsstyrning", "logga-in", "logga-ut", "skapa-konto",
    "anvandarupplevelse", "anvandarvillkor", "publikationer",
    "etik", "moral", "vara-natverk", "anmal", "kundtjanst", "kundservice",
    "gdpr",
]
URL_STOP_TOKENS_CLEAN = [t for t in URL_STOP_TOKENS if t != "agarekronika"] + ["kronika"]

# --- Fixed values: path fragments whose links the crawler follows.
FOLLOW_QUERIES = ["/om", "/about"]

# --- Fixed values: character filters applied to extracted text, in order.
# Java regex syntax; (?U) makes \s and \w Unicode-aware like the reference.
CHAR_FILTERS = [
    r"(?U)\s{2,}",
    r"\|+",
    r"\n+",
    r"\t+",
    r"\r+",
    r"(?U)#\w+",
    # The symbol ranges of the reference collapse to one class.
    r"[\x{24C2}-\x{10FFFF}\x{200D}\x{23CF}\x{23E9}\x{231A}]+",
]

# --- Fixed values: the emoji and symbol blocks of the reference's symbol
# filter, in its order, without its two all-covering ranges
# (U+24C2..U+1F251 and U+10000..U+10FFFF); used by the clean mode.
EMOJI_BLOCKS = [
    (0x1F600, 0x1F64F), (0x1F300, 0x1F5FF), (0x1F680, 0x1F6FF), (0x1F1E0, 0x1F1FF),
    (0x2702, 0x27B0), (0x1F926, 0x1F937), (0x2640, 0x2642), (0x2600, 0x2B55),
    (0x200D, 0x200D), (0x23CF, 0x23CF), (0x23E9, 0x23E9), (0x231A, 0x231A),
    (0xFE0F, 0xFE0F), (0x3030, 0x3030),
]

# Year filter: a string that starts with four digits.
YEAR_PREFIX = r"(?U)^\d{4}"

# --- Fixed values: evaluation and corpus parameters.
MAX_TEXT_CHARS = 1_000_000
MIN_TEXT_CHARS = 300
TOP_N = 5
DECISION_THRESHOLD = 0.368
SPLIT_PCT = (70, 20, 10)  # train, dev, test
FETCH_LIMIT = 50
LOOKUPS_PER_CODE = 100
CODE_RANGE = ("01120", "95290")

# Public suffixes known to the registered-domain rule (multi-label first is
# not needed: the longest matching suffix wins).
PUBLIC_SUFFIXES = [
    "se", "com", "net", "org", "io", "eu", "nu", "info", "biz", "dk", "no", "fi", "de",
    "uk", "co.uk", "org.uk", "ac.uk", "gov.uk", "fr", "es", "it", "nl", "be", "ch", "at",
    "us", "ca", "au", "com.au", "nz", "co.nz", "jp", "co.jp", "cn", "com.cn", "in",
    "co.in", "br", "com.br", "ru", "pl", "cz", "ee", "lv", "lt", "is", "gov", "edu",
    "app", "dev", "tech", "online", "shop", "xyz",
]
