"""Fixed vocabularies.

Every value in this module is a fixed value: results are only right when the
words, their spelling and their order are exactly these.  List order is
meaningful everywhere: it is the output order of multi-value matches and the
priority of first-match operators.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Technology keywords.  Seven words are listed twice and are
# emitted twice.  The two entries with backslashes are patterns, and the
# backslashes belong to the emitted value (see ``matching.KeywordSet``).
# --------------------------------------------------------------------------
TECH_KEYWORDS = [
    # programming languages
    "python", "java", r"c\\+\\+", "c#", "javascript", "typescript", "go", "rust", "kotlin", "swift",
    "php", "ruby", "scala", "matlab", "groovy", "perl",
    # web
    "html", "css", "react", "angular", "vue", "svelte", "nodejs", "express", "django", "flask",
    "fastapi", "spring boot", r"asp\\.net", "rails", "laravel", "webpack", "babel",
    # data
    "sql", "spark", "hadoop", "kafka", "elasticsearch", "pandas", "numpy", "scikit-learn",
    "dbt", "airflow", "prefect", "snowflake", "bigquery", "redshift", "hive", "presto",
    # machine learning
    "tensorflow", "pytorch", "keras", "scikit-learn", "nlp", "computer vision", "deep learning",
    "llm", "bert", "transformers", "hugging face", "xgboost", "lightgbm",
    # operations
    "docker", "kubernetes", "jenkins", "gitlab-ci", "github actions", "circleci", "terraform",
    "ansible", "prometheus", "grafana", "elk stack", "datadog", "newrelic", "linux",
    # cloud
    "aws", "azure", "gcp", "ec2", "s3", "lambda", "rds", "dynamodb", "cloudformation",
    "aks", "app service", "cosmos db", "gce", "cloud storage", "bigquery", "cloud dataflow",
    # databases
    "postgresql", "mysql", "mongodb", "redis", "cassandra", "dynamodb", "neo4j", "firebase",
    "memcached", "duckdb", "influxdb", "timescaledb",
    # mobile
    "swift", "kotlin", "react native", "flutter", "dart", "objective-c", "android",
    "ios", "xamarin", "ionic", "expo",
    # developer tools
    "git", "github", "gitlab", "bitbucket", "svn", "jira", "trello", "notion",
    "vscode", "intellij", "visual studio", "postman", "insomnia",
    # testing
    "junit", "pytest", "mocha", "jest", "selenium", "cypress", "postman", "jmeter",
    "sonarqube", "coverage", "tdd", "bdd",
    # messaging
    "rabbitmq", "kafka", "activemq", "aws sqs", "pubsub", "nats", "zeromq", "pulsar",
]

# Literal spellings that replace the two pattern entries under ``fix_cpp``.
TECH_KEYWORD_FIXES = {r"c\\+\\+": "c++", r"asp\\.net": "asp.net"}

# --------------------------------------------------------------------------
# Canonical role -> recognised title aliases, in priority order.
# --------------------------------------------------------------------------
ROLE_ALIASES = {
    "technical lead": ["technical lead", "tech lead", "software lead", "engineering lead"],
    "engineering manager": ["engineering manager", "software engineering manager"],
    "it manager": ["it manager", "information technology manager"],
    "fullstack": [
        "fullstack developer", "full stack developer", "full-stack developer",
        "fullstack engineer", "full stack engineer", "full-stack engineer", "fullstack",
    ],
    "frontend": [
        "frontend developer", "front end developer", "front-end developer",
        "frontend engineer", "front end engineer", "front-end engineer", "frontend",
    ],
    "backend": [
        "backend developer", "back end developer", "back-end developer",
        "backend engineer", "back end engineer", "back-end engineer", "backend",
    ],
    "mobile": [
        "android developer", "android engineer", "ios developer", "ios engineer",
        "flutter developer", "flutter engineer", "react native developer",
        "react native engineer", "mobile developer", "mobile engineer", "mobile",
    ],
    "game": ["game developer", "game engineer", "game programmer", "game"],
    "embedded": [
        "embedded software engineer", "embedded software developer", "embedded engineer",
        "embedded developer", "firmware engineer", "firmware developer", "embedded",
    ],
    "blockchain": ["blockchain developer", "blockchain engineer", "blockchain"],
    "salesforce": ["salesforce developer", "salesforce engineer", "salesforce"],
    "data engineer": ["big data engineer", "data engineer", "etl engineer", "etl developer"],
    "analytics engineer": ["analytics engineer"],
    "data analyst": ["data analyst"],
    "data science": ["data scientist", "data science"],
    "business intelligence": [
        "business intelligence developer", "business intelligence analyst",
        "bi developer", "bi analyst", "business intelligence",
    ],
    "database": [
        "database administrator", "database developer", "database engineer",
        "database specialist", "dba", "database",
    ],
    "deep learning": ["deep learning engineer", "deep learning"],
    "machine learning": [
        "machine learning engineer", "machine learning developer", "ml engineer",
        "ml developer", "machine learning",
    ],
    "computer vision": ["computer vision engineer", "computer vision developer", "computer vision"],
    "nlp": ["natural language processing engineer", "nlp engineer", "nlp developer", "nlp"],
    "ai": [
        "artificial intelligence engineer", "ai engineer", "ai developer",
        "artificial intelligence", "ai",
    ],
    "site reliability": ["site reliability engineer", "site reliability", "sre"],
    "devops": ["devops engineer", "devops developer", "devops"],
    "platform": ["platform engineer", "platform developer", "platform"],
    "solutions architect": ["solutions architect", "solution architect"],
    "cloud": ["cloud architect", "cloud engineer", "cloud developer", "cloud"],
    "infrastructure": ["infrastructure engineer", "infrastructure architect", "infrastructure"],
    "system administrator": [
        "linux administrator", "system administrator", "systems administrator", "sysadmin",
    ],
    "network": ["network engineer", "network administrator", "network architect", "network"],
    "qa": [
        "quality assurance engineer", "quality assurance analyst", "qa engineer", "qa analyst",
        "automation tester", "manual tester", "performance tester", "test automation engineer",
        "test engineer", "software tester", "qa",
    ],
    "security": [
        "cybersecurity analyst", "cyber security analyst", "information security analyst",
        "penetration tester", "security engineer", "security analyst", "soc analyst",
        "cybersecurity", "cyber security", "security",
    ],
    "it support": [
        "technical support engineer", "helpdesk technician", "help desk technician",
        "it support engineer", "it support specialist", "it support",
    ],
    "business analyst": ["business analyst"],
    "system analyst": ["systems analyst", "system analyst"],
    "product manager": ["product manager"],
    "product owner": ["product owner"],
    "project manager": ["project manager"],
    "scrum master": ["scrum master"],
    "designer": [
        "ui ux designer", "ui/ux designer", "ux designer", "ui designer", "product designer",
        "web designer", "designer",
    ],
    "sap consultant": ["sap consultant"],
    "erp consultant": ["erp consultant"],
    "software": [
        "software engineer", "software developer", "web developer", "web engineer",
        "application developer", "application engineer", "software",
    ],
}

# --------------------------------------------------------------------------
# Recognised phrases per label, in priority order.  A space
# stands for "any run of separators, possibly none" (see ``text.SEPARATOR``);
# everything else is ordinary regular-expression syntax.  Vietnamese phrases
# are listed without and with diacritics, in NFC.
# --------------------------------------------------------------------------
EMPLOYMENT_PHRASES = {
    "FULL_TIME": ["full time", "permanent", "toan thoi gian", "toàn thời gian"],
    "PART_TIME": ["part time", "ban thoi gian", "bán thời gian"],
    "INTERNSHIP": ["internship", "intern", "trainee", "thuc tap", "thực tập"],
}

LOCATION_PHRASES = {
    "REMOTE": ["remote", "work from home", "wfh", "lam viec tu xa", "làm việc từ xa"],
    "HYBRID": ["hybrid", "remote and office", "office and remote", "linh hoat", "linh hoạt"],
    "ON_SITE": ["on site", "onsite", "in office", "at office", "office", "van phong", "văn phòng"],
}

SENIORITY_PHRASES = {
    "Entry": [
        "entry", "entry level", "fresher", "fresh graduate", "graduate", "new grad",
        "moi ra truong", "mới ra trường",
    ],
    "Junior": [
        "junior", r"jr\.?", "associate", "0 1 years?", "1 year", "duoi 1 nam", "dưới 1 năm",
    ],
    "Mid-Level": [
        "mid", "middle", "mid level", "intermediate", "2 4 years?", r"2\+ years?", r"3\+ years?",
    ],
    "Senior": [
        "senior", r"sr\.?", "experienced", r"5\+ years?", "5 years?", "trên 5 năm", "tren 5 nam",
    ],
    "Lead": [
        "lead", "team lead", "tech lead", "technical lead", "leader", "truong nhom", "trưởng nhóm",
    ],
    "Principal": ["principal", "principal engineer", "architect"],
    "Staff": ["staff", "staff engineer"],
    "Manager": ["manager", "engineering manager", "head of", "quan ly", "quản lý"],
    "Director": ["director", "director of", "giam doc", "giám đốc"],
    "VP": ["vp", "vice president"],
    "C-Level": [
        "c level", "cto", "cio", "ceo", "coo",
        "chief (?:technology|information|executive|operating) officer",
    ],
}

# Words that make a number an amount of experience.
YEAR_WORDS = ["years?", "yrs?", "nam", "năm"]
EXPERIENCE_WORDS = ["experience", "exp", "kinh nghiem", "kinh nghiệm"]

# Words of a salary phrase.
SALARY_PREFIXES = ["up to", "upto", "from", "to", "tu", "từ", "den", "đến"]
SALARY_CURRENCIES = "$€£"
SALARY_RANGE_WORDS = ["to", "den", "đến"]
SALARY_UNITS = ["usd", "vnd", "vnđ", "trieu", "triệu", "million"]
SALARY_WORDS = ["negotiable", "competitive", "thoa thuan", "thỏa thuận"]

# Words of a relative posting date.
MINUTE_WORDS = ["minutes?", "mins?", "min", "phut", "phút"]
HOUR_WORDS = ["hours?", "hrs?", "hr", "gio", "giờ"]
DAY_WORDS = ["days?", "ngay", "ngày"]
WEEK_WORDS = ["weeks?", "wks?", "tuan", "tuần"]
AGO_WORDS = ["ago", "truoc", "trước"]
YESTERDAY_PHRASES = ["yesterday", "hom qua", "hôm qua"]

# Spellings that mean "no value" (after lower and trim).
UNKNOWN_LIKE = ["", "unknown", "n/a", "na", "none", "null"]

# --------------------------------------------------------------------------
# Technology categories of the technology dimension.
# --------------------------------------------------------------------------
TECH_CATEGORIES = {
    "Programming Language": ["python", "java", "javascript", "typescript", "go", "rust", "c++"],
    "Frontend Framework": ["react", "vue", "angular", "nextjs"],
    "Backend Framework": ["django", "flask", "spring", "express"],
    "Database": ["postgresql", "mysql", "mongodb", "redis"],
    "Cloud/DevOps": ["aws", "gcp", "azure", "docker", "kubernetes"],
}

# Rows of the location dimension (id, country, district, city).
LOCATION_ROWS = [
    ("LOC_REMOTE", "Remote", "N/A", "N/A"),
    ("LOC_ONSITE", "Vietnam", "N/A", "N/A"),
    ("LOC_HYBRID", "Vietnam", "N/A", "N/A"),
    ("LOC_NA", "N/A", "N/A", "N/A"),
]

# Role slugs that make up the crawl frontier.
CRAWL_ROLE_SLUGS = [
    "backend", "frontend", "fullstack", "mobile", "python", "embedded", "game", "blockchain", "AI",
    "data", "devops", "cloud", "security", "qa", "it-support",
]
