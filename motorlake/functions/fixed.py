"""Words, labels, patterns and messages that results depend on."""

# Labels on a listing page, each followed by its value on the next text line.
LABEL_CITY = "Город"
LABEL_REGION = "Регион"
LABEL_AREA = "Область"
LABEL_GENERATION = "Поколение"
LABEL_BODY = "Кузов"
LABEL_GEARBOX = "Коробка передач"
LABEL_DRIVE = "Привод"
LABEL_STEERING = "Руль"
LABEL_COLOR = "Цвет"
LABEL_CUSTOMS = "Растаможен в Казахстане"
LABEL_ENGINE = "Объем двигателя, л"
LABEL_MILEAGE = "Пробег"
LABEL_MILEAGE_KM = "Пробег, км"
LABEL_SELLER = "Проверенный продавец"
LABEL_OPTIONS = "Опции и характеристики"
OPTIONS_STOP_LABELS = ["Город", "Поколение", "Кузов"]
OPTIONS_WINDOW = 19
YES, NO = "Да", "Нет"
TITLE_SKIP_WORDS = ["г.", "год", "year"]

# Block-page detection.
SHORT_PAGE_CHARS = 5000
SHORT_PAGE_WORDS = ["captcha", "cloudflare", "challenge", "verify"]
SHORT_PAGE_REASON = "Suspiciously short response with blocking keywords"
BLOCK_PATTERNS = [
    ("cloudflare.*ray.*id", "Cloudflare protection page"),
    ("checking.*browser.*before.*accessing", "Cloudflare challenge"),
    ("please.*complete.*security.*check", "Security check required"),
    ("unusual.*traffic.*detected", "Unusual traffic detected"),
    ("access.*denied.*robot", "Access denied - robot"),
    ("verify.*you.*are.*human", "Human verification required"),
    ("captcha.*challenge", "CAPTCHA challenge page"),
]
BLOCK_TITLE_WORDS = ["captcha", "challenge", "verify", "blocked", "access denied"]
BLOCK_TITLE_REASON = "Blocking page title: "
BLOCK_TITLE_CHARS = 50
CF_RAY_CHARS = 20000
CF_RAY_WORDS = ["challenge", "checking"]
CF_RAY_REASON = "Cloudflare challenge page"

# Listing ids on an index page.
ID_PATTERNS = [
    r"listing\.grid\.push\(\{\s*id:\s*(\d+)",
    r"/a/show/(\d+)",
    r"""(?i)data-listing-id=["'](\d+)["']""",
    r"""(?i)href=["']/a/show/(\d+)""",
]

# Secret redaction, applied in this order: (pattern, replacement).
REDACTIONS = [
    (r"://([^:]+):([^@]+)@", "://$1:***@"),
    (r"""(password|secret|key|token)["']?\s*[:=]\s*["']?([^"'\s]+)""", '$1="***"'),
    (
        r"(POSTGRES_PASSWORD|WAREHOUSE_PASSWORD|AIRFLOW_PASSWORD|MINIO_SECRET_KEY|SUPABASE_DB_URL|PGADMIN_PASSWORD)"
        r"""["']?\s*[:=]\s*["']?([^"'\s]+)""",
        '$1="***"',
    ),
]

# A text without any of these and without '://' has nothing to redact; the last
# one is a letter that equals 's' when case is ignored.
REDACTION_WORDS = ["password", "secret", "key", "token", "supabase_db_url", "\u017f"]

# Queue states and outcomes.
STATE_NEW, STATE_FETCHED, STATE_RETRY, STATE_INACTIVE = "NEW", "FETCHED", "RETRY", "INACTIVE"
BLOCKED_ERROR = "Blocking detected"
BACKOFF_CAP_MINUTES = 1440

# Columns that hold whole numbers in every published table.
INTEGER_COLUMNS = [
    "views", "photo_count", "days_on_site", "date_key", "listing_id", "location_key", "vehicle_key",
    "seller_key", "car_year", "year", "quarter", "month", "day_of_week", "seller_user_id",
]
LIST_SEPARATOR = "; "
CURRENCY = "KZT"
CALENDAR_REACH_DAYS = 365
VIEWS_CHUNK = 50
FETCH_BATCH = 5
CLAIM_BATCH = 200
RECENT_ERRORS = 10
