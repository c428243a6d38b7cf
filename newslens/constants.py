"""Values that results depend on.

Everything under a "Fixed values" heading has to stay exactly as it is for the
output to agree with existing corpora, workbooks and reports.
"""

# --- Fixed values: article file format ------------------------------------
TITLE_PREFIX = "标题:"
URL_PREFIX = "网址:"
IMAGE_LIST = "图片列表:"
VIDEO_LIST = "视频列表:"
VIDEO_LINK_PREFIX = "视频链接:"
SIZE_LABEL = "尺寸:"
UNSAFE_IN_FILE_NAMES = r'[\\/*?:"<>|]'
TRAILING_SECTIONS = ("Specials", "Videos")

# --- Fixed values: sentiment report format --------------------------------
REPORT_TITLE = "情感分析详细结果"
REPORT_RULE = "=============="
REPORT_SUMMARY = "汇总统计:"
REPORT_TOTAL = "总计"
REPORT_SECTIONS = (
    ("positive", "正向报道"),
    ("negative", "负面报道"),
    ("neutral", "中性报道"),
)
REPORT_LIST = "列表"
REPORT_SCORE = "得分:"
REPORT_LINE = r"\d+\.\s+(.+?)\s+\(" + REPORT_SCORE + r"\s+(-?\d+\.\d+)\)"

# --- Fixed values: column aliases of the URL sheet, first present wins ----
TITLE_ALIASES = ("标题", "文章标题", "title", "Title", "字段1_文本_文本")
URL_ALIASES = ("网址", "链接", "url", "URL", "link", "Link", "字段1_链接_链接")

# --- Fixed values: stop words ---------------------------------------------
STOP_WORDS_ZH = (
    "的 了 在 是 我 有 和 就 不 人 都 一 一个 上 也 很 到 说 要 去 你 会 着 没有 看 好 "
    "自己 这 这个 来 什么 那 可以 中 大 为 他 她 标题 网址 图片 列表 视频 尺寸 所示"
).split()

STOP_WORDS_EN = (
    "the and of to in for is on that with by at as it be this an are was from has have "
    "will its which not or a also can their they said were been would more we other year all "
    "had our new one two his her him she he i"
).split()

STOP_WORDS_EN_EXTENDED = (
    "the and of to in for is on that with by at as it be this an are was from has have "
    "will its which not or a also can their they said were been would more we other year all "
    "had our new one two his her him she he i "
    "am being do does did but if because until while about against between into through during "
    "before after above below up down out off over under again further then once here there when "
    "where why how any both each few most some such only own same so than too very s t just now"
).split()

# --- Fixed values: term reports -------------------------------------------
ENGLISH_TOP_TERMS = 100
MIXED_TOP_TERMS = 50
MIN_TERM_COUNT = 3
SHEET_ROWS = 40

# --- Fixed values: sentiment classes --------------------------------------
POSITIVE_FROM = 0.05
NEGATIVE_TO = -0.5
# sentiment, confidence, positive, negative, neutral, joy, trust, fear, surprise
CLASS_RATES = (
    ("positive", 85.0, 90.0, 5.0, 5.0, 80.0, 75.0, 10.0, 20.0),
    ("negative", 85.0, 5.0, 90.0, 5.0, 10.0, 15.0, 70.0, 30.0),
    ("neutral", 85.0, 50.0, 25.0, 25.0, 10.0, 15.0, 70.0, 30.0),
)

# --- Fixed values: corpus defaults and enumerations -----------------------
DEFAULT_SOURCE = "china"
DEFAULT_MEDIA = "China Daily"
DEFAULT_TYPE = "text"
SOURCES = ("china", "usa", "russia")
CONTENT_TYPES = ("text", "image", "video")
SENTIMENTS = ("positive", "neutral", "negative")
IMAGE_FORMATS = ("jpg", "jpeg", "png", "gif", "webp")
KEYWORD_TYPES = ("person", "organization", "location", "technology", "other")
DEFAULT_KEYWORD_TYPE = "other"
PROCESS_TYPES = ("crawl", "sentiment_analysis", "keyword_extraction", "statistics")
PROCESS_STATES = ("success", "failed", "running")
TITLE_MAX = 500
URL_MAX = 1000
PATH_MAX = 500
MEDIA_NAME_MAX = 200
KEYWORD_MAX = 100

# --- Fixed values: retention ----------------------------------------------
RETENTION_FIRST_YEAR = 2015

# --- Fixed values: web page extraction ------------------------------------
CONTAINER_SELECTORS = (
    "article", ".article", ".content", ".post", ".entry", ".main-content",
    "#content", "#article", ".story", ".detail", ".article-content",
    ".article-body", ".post-content", ".entry-content", ".main",
    ".text", ".body", "#main", ".container", ".wrapper",
)
BOILERPLATE_TAGS = ("script", "style", "nav", "footer", "aside")
BLOCK_TAGS = ("p", "h1", "h2", "h3", "h4", "h5", "h6")
LOOSE_PARAGRAPH_MIN = 30
IMAGE_SOURCE_ATTRS = ("src", "data-src", "data-original", "data-original-src", "data-lazy-src")
LAZY_IMAGE_ATTRS = ("data-original-src", "data-lazy-src")
ICON_MARKS = ("icon", "logo")
AD_MARKS = ("ad.", "ad/", "advert", "advertisement")
BACKGROUND_MARKS = ("icon", "logo", "banner", "button", "bg-", "background")
MIN_IMAGE_WIDTH = 300
MIN_IMAGE_HEIGHT = 200
VIDEO_FRAME_MARKS = ("video", "player", "youtube", "vimeo")
VIDEO_LINK_MARKS = ("youtube.com", "vimeo.com", "player")
VIDEO_CLASS_MARKS = ("video", "player", "media")
VIDEO_DATA_ATTRS = ("data-video", "data-src", "data-video-src", "data-source")
VIDEO_DATA_FORMATS = ("mp4", "webm", "ogg")
VIDEO_SCRIPT_PATTERN = (
    r"(?:video|source|media)(?:Url|URL|url|Src|src)(?:\s*:\s*|\s*=\s*)"
    r"['\"]([^\"']+\.(?:mp4|webm|ogg))['\"]"
)
BACKGROUND_PATTERN = r"background(?:-image)?\s*:\s*url\(['\"]?(.*?)['\"]?\)"
# (substring of the content type, extension), tested in this order
IMAGE_EXTENSIONS = (("jpeg", "jpg"), ("jpg", "jpg"), ("png", "png"), ("gif", "gif"), ("webp", "webp"))
VIDEO_EXTENSIONS = (("mp4", "mp4"), ("webm", "webm"), ("ogg", "ogg"))
DEFAULT_IMAGE_EXTENSION = "jpg"
DEFAULT_VIDEO_EXTENSION = "mp4"

# --- Character classes (portable between Java, Python and RE2) -------------
WORD = r"[\p{L}\p{N}_]"
BLANK = r"[\s\x0B\x1c-\x1f\x{85}\p{Z}]"
CJK = r"[\x{4e00}-\x{9fa5}]"
