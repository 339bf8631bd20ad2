"""Word lists, lookup tables and patterns. All are fixed values that results depend on; lists grow by adding entries."""

from __future__ import annotations

# --- fixed values: places, countries, hosts, names -----------------------------------------------------------------
PLACES = (
    "israel", "tel aviv", "tel-aviv", "telaviv", "tel aviv-yafo", "tel aviv-jaffa", "jerusalem", "haifa", "herzliya", "herzelia", "herzeliya",
    "hertzeliya", "herzliya pituach", "ra'anana", "raanana", "ra anana", "netanya", "nathania", "ramat gan", "ramat-gan", "petah tikva",
    "petach tikva", "petah tiqwa", "petah-tikva", "beer sheva", "be'er sheva", "beersheba", "beer-sheva", "beersheva", "yokneam", "yoqneam",
    "caesarea", "qesarya", "kiryat gat", "kiryat-gat", "kiryat ono", "kiryat motzkin", "kiryat shmona", "kiryat bialik", "rehovot", "rechovot",
    "hod hasharon", "hod ha'sharon", "or yehuda", "airport city", "modiin", "modi'in", "modiin-maccabim-reut", "ness ziona", "rishon lezion",
    "kfar saba", "tirat carmel", "nes ziona", "nes tziona", "givatayim", "holon", "rosh haayin", "rosh ha'ayin", "rosh ha ayin", "karmiel",
    "carmiel", "migdal haemek", "migdal ha'emek", "yakum", "bnei brak", "bene beraq", "lod", "ashdod", "ashkelon", "ramat hahayal",
    "ramat ha'hayal", "afek", "sderot", "nazareth", "nazareth illit", "nof hagalil", "tirat hakarmel", "even yehuda", "azor",
)

COUNTRY_CODES = {
    "israel": "IL", "united states": "US", "usa": "US", "united states of america": "US", "united kingdom": "GB", "uk": "GB", "germany": "DE",
    "france": "FR", "spain": "ES", "portugal": "PT", "india": "IN", "canada": "CA", "australia": "AU", "ireland": "IE", "netherlands": "NL",
    "poland": "PL", "romania": "RO", "singapore": "SG", "japan": "JP", "china": "CN", "brazil": "BR", "mexico": "MX", "sweden": "SE",
    "switzerland": "CH", "italy": "IT", "austria": "AT", "czech republic": "CZ", "czechia": "CZ", "bulgaria": "BG", "greece": "GR",
    "hong kong": "HK", "south korea": "KR", "korea": "KR", "taiwan": "TW", "united arab emirates": "AE", "uae": "AE",
}

REGIONS_DROPPED = ("il", "israel", "isr", "tel aviv district", "central district", "center district", "hamerkaz", "haifa district", "southern district", "northern district", "jerusalem district", "hadarom", "hatzafon", "center")

CITY_NAMES = {
    "tel aviv-yafo": "Tel Aviv", "tel aviv-jaffa": "Tel Aviv", "tel aviv jaffa": "Tel Aviv", "telaviv": "Tel Aviv", "tel-aviv": "Tel Aviv",
    "tlv": "Tel Aviv", "ramat-gan": "Ramat Gan", "petah-tikva": "Petah Tikva", "petach tikva": "Petah Tikva", "rishon lezion": "Rishon LeZion",
    "rishon le zion": "Rishon LeZion", "kiryat bialik": "Kiryat Bialik", "beer sheva": "Be'er Sheva", "beersheba": "Be'er Sheva",
    "יפו": "Tel Aviv", "תל אביב": "Tel Aviv", "תל אביב-יפו": "Tel Aviv", "באר שבע": "Be'er Sheva", "רעננה": "Ra'anana", "הרצליה": "Herzliya",
    "חיפה": "Haifa", "ירושלים": "Jerusalem", "פתח תקווה": "Petah Tikva", "רמת גן": "Ramat Gan", "חולון": "Holon", "נתניה": "Netanya",
    "יקנעם עילית": "Yokneam", "יקנעם": "Yokneam", "טירת כרמל": "Tirat Carmel", "מחוז הצפון": "Northern Israel", "מחוז המרכז": "Central Israel",
    "מחוז תל אביב": "Tel Aviv", "מחוז חיפה": "Haifa area", "ישראל": "Israel (unspecified)",
}

LISTING_HOSTS = (
    "linkedin.", "indeed.", "glassdoor.", "secrethunter.", "t.me/", "builtin.com", "ziprecruiter.", "monster.", "dice.com", "simplyhired.",
    "careerbuilder.", "wellfound.com", "angel.co", "startup.jobs", "themuse.com", "jobvite.com/search", "talent.com", "jooble.", "neuvoo.",
    "adzuna.", "getclera.com", "welcometothejungle.com", "techaviv.com", "secretjobs.ai", "jobs.techaviv", "drushim.co.il", "alljobs.co.il",
    "jobmaster.co.il", "ethosia.", "gotfriends.", "climatetechlist.", "foodimpactcareers.", "infosecjobboard.", "web3.career", "embedded.jobs",
    "myjobmag.", "devjobs.co.il", "jobify360.", "tlv.partners", "insightpartners.com", "seedcamp.com", "getro.", "consider.vc",
    "jobs.ashbyhq.com/vc", "duckduckgo.", "google.com/search", "bing.com/search", "bebee.com", "djinni.co", "craft.co", "franciscopartners.com",
    "himalayas.app", "remoteok.", "weworkremotely.", "jobgether.", "startupnationcentral.org",
)

AGENCIES = (
    "comblack", "sqlink group", "sqlink", "recruitx", "talent-hr", "talent hr", "elad software systems", "experis", "experis israel",
    "experis academy israel", "אקספריס", "אקספריס אקדמי", "מנפאואר", "אלעד מערכות", "ניסן דיגיטל", "אתגר", "abra", "abra rnd", "abra r&d",
    "malamteam", "malam team", "yael group", "yael korentec technologies", "moveo source", "nogamy", "g-stat", "log-on software", "matchit",
    "confidential careers", "confidential",
)
AGENCY_WORDS = r"(?i)\b(recruit(ing|ment|x)?|staffing|headhunt(ing|ers?)?|manpower|placement agenc|talent acquisition|gotfriends|hr solutions)\b"

HIRING_HOSTS = r"(?i)greenhouse\.io|lever\.co|ashbyhq\.com|smartrecruiters\.com|comeet\.co|workable\.com|recruitee\.com|myworkdayjobs|breezy\.hr|bamboohr\.com|oraclecloud\.com|applytojob\.com|jazz\.co|amazon\.jobs|careers\.microsoft\.com"
BOARD_HOSTS = r"(?i)(greenhouse|lever\.co|ashbyhq|comeet|myworkdayjobs|workday|smartrecruiters|recruitee|workable|bamboohr|breezy\.hr|jazzhr|applytojob|icims|oraclecloud|successfactors|phenom|eightfold|avature|careers-page\.com|rippling|hibob|teamtailor|willhire|comeet\.com|jobs\.ashbyhq)"

PARENT_HOSTS = {
    "aws": ("amazon.jobs", "amazon.com"), "amazon web services": ("amazon.jobs", "amazon.com"), "google israel": ("google.com", "abc.xyz"),
    "microsoft israel": ("microsoft.com",), "microsoft (xbox/gaming)": ("microsoft.com",),
    "volkswagen (cariad)": ("volkswagen-group.com", "cariad.technology"), "siemens digital industries software": ("sw.siemens.com", "siemens.com"),
    "siemens eda": ("sw.siemens.com", "siemens.com"), "applied materials israel": ("appliedmaterials.com",),
}

COMMON_NAME_WORDS = (
    "the", "group", "israel", "technologies", "technology", "systems", "software", "solutions", "labs", "inc", "ltd", "corp", "company",
    "holdings", "international", "digital", "global", "security", "tech", "ai", "co", "robotics", "financial", "finance", "medical",
    "analytics", "energy", "foods", "food", "pharma", "pharmaceutical", "pharmaceuticals", "health", "healthcare", "bio", "nano", "cyber",
    "data", "cloud", "capital", "ventures", "industries", "networks", "semiconductor", "semiconductors", "electronics", "intelligence",
    "imaging", "sciences", "science", "media", "mobile", "motors", "automotive", "insurance", "bank", "telecom", "communications",
    "materials", "storage", "vision", "power",
)

MERGE_SUFFIX = r"(?i)\s+(ltd|inc|llc|corp|co|gmbh|technologies|software|labs|group)\.?$"
IDENTITY_SUFFIXES = ("ltd", "inc", "llc", "corp", "corporation", "co", "gmbh", "group", "technologies", "technology", "software", "labs", "solutions", "systems", "israel", "global")
IDENTITY_ALIASES = {
    "aws": "amazon", "amazon web services": "amazon", "jpmorganchase": "jpmorgan chase", "aqurate data": "aqurate", "cadence design": "cadence",
    "habana labs intel": "habana", "vmware broadcom": "vmware", "simply joytunes": "simply", "merck msd": "merck",
}
ANNOTATION = r"(?i)^\s*(formerly|now|part of|acquired|previously|by |a |an )"
JUNK_NAME = r"(?i)\b(developer|engineer(ing)?|scientist|researcher|analyst|architect|designer|manager|lead|specialist|consultant|intern|student|qa|devops|full[- ]?stack|back[- ]?end|front[- ]?end)\b.*([-–—@]|\bat\b)|^(my team|our team|the team)$"
CATEGORY_NAMES = ("appsec", "devops", "devsecops", "data", "security", "cyber", "qa", "fintech", "hr", "it", "ai", "ml", "cloud", "digital", "r&d", "backend", "frontend", "fullstack", "mobile", "web")

SECTORS = (
    ("cybersecurity", ("cyber", "security")),
    ("fintech", ("fintech", "payments", "banking", "insur", "crypto", "trading")),
    ("healthtech", ("health", "medical", "pharma", "biotech", "life science")),
    ("adtech / martech", ("adtech", "martech", "marketing tech", "advertising")),
    ("gaming", ("gaming", "igaming", "casino")),
    ("automotive / semiconductors", ("automotive", "semiconductor", "chip", "lidar", "mobility")),
    ("SaaS", ("saas", "productivity", "enterprise software", "work management")),
    ("data / AI infrastructure", ("data analytics", "ai infrastructure", "devtools", "cloud comput", "platform engineering", "data infrastructure", "observability")),
    ("e-commerce / marketplace", ("e-commerce", "ecommerce", "marketplace", "retail tech")),
    ("IT services", ("it services", "consulting", "outsourcing", "recruitment", "staffing")),
)

NOTE_TOKENS = (
    "scanned; no open", "unreachable", "aggregator URL", "no ATS detected", "unsupported ATS", "scanned via brightdata", "roles-text present",
    "empty-but-suspect", "no listing found", "no IL listing", "monitored candidate", "host documented", "probe-woken", "scrape rotted",
    "redirects to", "needs re-resolution", "needs manual resolution", "dark-triage",
)
NOTE_FINAL = ("defunct", "domain-dead", "duplicate of", "redundant", "recruiter")

JUNK_MARKUP = r"(?i)(var\(--|data-turn-id|pointer-events|_threadScroll|token-text-primary|\[calc\(|scroll-m[btlr]-\[|class=)"

# --- fixed values: title rules ---------------------------------------------------------------------------------------
TITLE_EXCLUDED = (
    r"(?i)\b(software|backend|back-end|frontend|front-end|full ?stack|web developer|data engineer|data engineering|analytics engineer|platform engineer|"
    r"devops|dev ops|sre|site reliability|infrastructure|embedded|firmware|qa engineer|automation engineer|security engineer|solutions? engineer|"
    r"sales engineer|support engineer|hardware|elect(ronic|rical)|mechanical|machine learning|deep learning|\bml\b|mlops|ml ops|\bnlp\b|computer vision|"
    r"algorithm(s)? engineer|algo engineer|security analyst|soc analyst|infosec analyst|information security analyst|compliance analyst|governance analyst|"
    r"financial analyst|finance analyst|credit analyst|investment analyst|equity analyst|budget analyst|treasury analyst|actuarial analyst|billing analyst|"
    r"qa analyst|quality assurance analyst|test analyst|systems? analyst|it analyst|network analyst|application analyst|support analyst|"
    r"service desk analyst|help ?desk analyst|desktop analyst)\b|\b(fp&a|actuary)\b"
)
TITLE_STRONG = (
    r"(?i)(\bdata analyst|\bbusiness analyst|\bb\.?i\.? analyst|business intelligence|\bbi (developer|lead|manager|analyst)|"
    r"analytics (manager|team ?lead|lead|director)|(head|director|vp|vice president) of analytics|\bproduct analyst|\bmarketing analyst|\bgrowth analyst|"
    r"\breporting analyst|\binsight?s analyst|customer insights|\bweb analyst|\bdigital analyst|\bdata analytics|data scientist,?\s+(product\s+)?analytics|"
    r"(product|decision|marketing|growth|business)\s+(data\s+)?scientist|data scientist,?\s+(product|marketing|growth|business|insights?)\b)"
)
TITLE_SIGNAL = (
    r"(?i)(\banalyst\b|analytics|business intelligence|\bbi\b|insight|data scien|data scientist|decision scien|scientist|"
    r"reporting|\bmetrics\b|statistician|econometr|\bquant\b|quantitative)|אנליסט|אנליטיקה|נתונים|בינה עסקית|דאטה"
)
TITLE_SENIOR = r"(?i)\b(senior|sr\.?|staff|principal|lead|head|director|vp|vice president|chief|expert|manager)\b|בכיר|בכירה|ראש צוות|ראש תחום|מוביל|מובילה|מנהל|מנהלת|סניור"
TITLE_JUNIOR = r"(?i)\b(junior|jr\.?|intern|internship|student|trainee|apprentice|graduate|entry[- ]?level|working student|campus|early[- ]?career)\b"
TEXT_MODELLING = (
    r"(?i)\b(machine learning|deep learning|\bml\b|mlops|\bnlp\b|computer vision|neural network|\bllms?\b|large language model|generative ai|"
    r"reinforcement learning|model (training|development|building|deployment)|train(ing)? (models?|deep|neural)|pytorch|tensorflow|hugging ?face|"
    r"transformer model|data science projects?|scientific reasoning|\bpymc\b|bayesian|xgboost|scikit|keras|recommendation (system|engine)|"
    r"real[- ]time bidding|feature engineering|predictive model|statistical model(l?ing)?|ml algorithms?|research scientist)\b"
)
TEXT_ANALYTICS = (
    r"(?i)\b(dashboard|a/b test|a-b test|experiment|business metrics|\bkpis?\b|stakeholder|reporting|report\b|tableau|looker|power ?bi|\bbi\b|"
    r"product analytics|business intelligence|data visuali|ad[\s-]?hoc|\bsql\b|\binsights?\b|business questions?|self[- ]serve|decision[- ]making|"
    r"analytic|analyz|querying)"
)
ROLE_START = (
    r"(?i)\b(about the role|the role\b|responsibilit|what you'?ll|what we'?re looking|requirements?|qualifications?|as an? |in this role|you'?ll |"
    r"your role|day[- ]to[- ]day|we'?re looking for a|what you.?ll do|what you.?ll own)"
)
TITLE_ANCHOR = r"(?i)\b(data|analyt|business intelligence|\bbi\b|insight|reporting|metrics?|statistic|econometr|\bquant\b)"
BARE_SCIENTIST = r"(?i)\bdata scien(?:ce|tist)\b"
SCIENTIST_QUALIFIER = r"(?i)analyt|\banalyst\b|insight|business intelligence|\bbi\b|reporting|marketing|growth|decision|product"

# --- fixed values: role profile --------------------------------------------------------------------------------------
SKILLS = {
    "query": (
        ("SQL", r"\bsql\b"), ("Snowflake", r"\bsnowflake\b"), ("BigQuery", r"\bbig ?query\b"), ("Redshift", r"\bredshift\b"),
        ("SQL Server", r"\bsql server\b|\bt-?sql\b|\bms ?sql\b|\bssms\b"), ("PostgreSQL", r"\bpostgre(?:s|sql)?\b"), ("MySQL", r"\bmysql\b"),
        ("Oracle", r"\boracle\b"), ("MongoDB", r"\bmongo ?db\b"), ("Elasticsearch", r"\belastic ?search\b"), ("Databricks", r"\bdatabricks\b"),
        ("Spark", r"\b(?:py)?spark\b"), ("ClickHouse", r"\bclickhouse\b"), ("Vertica", r"\bvertica\b"), ("Presto/Trino/Athena", r"\bpresto\b|\btrino\b|\bathena\b"),
        ("Hive", r"\bhive\b"), ("Teradata", r"\bteradata\b"), ("DuckDB", r"\bduckdb\b"), ("Firebolt", r"\bfirebolt\b"), ("Splunk", r"\bsplunk\b"),
        ("Synapse", r"\bazure synapse\b|\bsynapse analytics\b"),
    ),
    "prog": (
        ("Python", r"\bpython\b|פייתון"), ("R", r"(?<![\w&.+/-])R(?![\w&.+#-])(?=[\s,/;.)]|$)"), ("SAS", r"\bsas\b"), ("VBA", r"\bvba\b|\bexcel macros?\b|\bmacros\b"),
        ("Scala", r"\bscala\b"), ("Java", r"\bjava\b(?!script)"), ("MATLAB", r"\bmatlab\b"), ("SPSS/Stata", r"\bspss\b|\bstata\b"),
        ("SageMaker/Vertex AI", r"\bsagemaker\b|\bvertex ai\b|\bmlflow\b"),
    ),
    "bi": (
        ("Excel", r"(?<![a-z])excel\b(?!\s+(?:in|at|as)\b)|\bpivot tables?\b|אקסל"), ("Tableau", r"(?<![a-z])tableau\b|טאבלו"),
        ("Power BI", r"\bpower\s?-?\s?bi\b|\bdax\b|\bpower query\b"), ("Looker", r"\blooker\b(?! studio)"), ("Looker Studio", r"\blooker studio\b|\bdata studio\b"),
        ("Qlik", r"\bqlik(?:view| sense)?\b"), ("Sisense", r"\bsisense\b"), ("MicroStrategy", r"\bmicrostrategy\b"), ("OBIEE", r"\bobiee\b|\boracle bi\b"),
        ("SAP BO", r"\bsap (?:bo|business ?objects)\b"), ("Superset", r"\bsuperset\b"), ("Grafana", r"\bgrafana\b"), ("Datadog", r"\bdatadog\b"),
        ("Hex/Mode", r"\bhex\b(?![a-z])|\bmode analytics\b|\blightdash\b"), ("Cognos", r"\bcognos\b"), ("Metabase", r"\bmetabase\b"), ("Redash", r"\bredash\b"),
        ("Domo", r"\bdomo\b"), ("ThoughtSpot", r"\bthoughtspot\b"), ("Google Sheets", r"\bgoogle sheets\b|\bgsheets?\b"), ("Streamlit", r"\bstreamlit\b"),
        ("Google Analytics", r"\bgoogle analytics\b|\bga4\b|\buniversal analytics\b|\bfirebase\b"), ("Amplitude", r"\bamplitude\b"), ("Mixpanel", r"\bmixpanel\b"),
        ("Pendo", r"\bpendo\b"), ("Heap", r"\bheap\b"), ("Hotjar/FullStory", r"\bhotjar\b|\bfullstory\b|session replay"),
    ),
    "pa": (
        ("Google Tag Manager", r"\bgoogle tag manager\b|\bgtm\b"), ("AppsFlyer/MMP", r"\bappsflyer\b|\badjust\b|\bsingular\b|\bmmp\b|\bmobile measurement\b"),
        ("Google Ads", r"\bgoogle ads\b|\badwords\b|\bppc\b|\bsem\b"), ("Meta Ads", r"\bfacebook ads\b|\bmeta ads\b"),
        ("TikTok/LinkedIn Ads", r"\btiktok ads\b|\blinkedin ads\b|\bpaid social\b"), ("SEO", r"\bseo\b"), ("CRM/Salesforce", r"\bsalesforce\b|\bhubspot\b|\bcrm\b"),
        ("Braze/Iterable", r"\bbraze\b|\biterable\b|\bmarketing automation\b"), ("SAP ERP", r"\bsap\b(?!\s*(?:bo\b|business\s?objects))"),
        ("Priority ERP", r"\bpriority erp\b|פריוריטי"), ("Jira", r"\bjira\b"), ("monday.com", r"\bmonday\.com\b"),
    ),
    "de": (
        ("ETL", r"\betl\b|\belt\b"), ("dbt", r"\bdbt\b"), ("Airflow", r"\bair ?flow\b"), ("SSIS/SSAS", r"\bssis\b|\bssas\b|\bssrs\b"),
        ("Data modeling", r"\bdata model(?:ing|ling|s)?\b|\bdimensional model|\bstar schema\b"), ("Data warehouse", r"\bdata ?warehouse\b|\bdwh\b"),
        ("Kafka", r"\bkafka\b"), ("Fivetran", r"\bfivetran\b|\bstitch\b"), ("Snowplow", r"\bsnowplow\b"),
        ("Talend/Informatica", r"\btalend\b|\binformatica\b|\bpentaho\b|\bdatastage\b"), ("AWS Glue", r"\baws glue\b|\bglue jobs?\b"),
        ("Segment/CDP", r"\bsegment\.(?:io|com)\b|twilio segment|\bcdp\b|customer data platform"), ("Git", r"\bgit(?:hub|lab)?\b"),
        ("Microsoft Fabric", r"\bmicrosoft fabric\b|\bms fabric\b|\bonelake\b"), ("Power Platform", r"\bpower (?:platform|apps|automate)\b"),
        ("Workato/Zapier/Make", r"\bworkato\b|\bzapier\b|\bn8n\b|\bmake\.com\b"), ("Alteryx/KNIME", r"\balteryx\b|\bknime\b"),
        ("Delta Lake/Iceberg", r"\bdelta lake\b|\biceberg\b|\blakehouse\b"),
    ),
    "cloud": (("AWS", r"\baws\b|\bamazon web services\b"), ("GCP", r"\bgcp\b|\bgoogle cloud\b"), ("Azure", r"\bazure\b")),
    "method": (
        ("A/B testing", r"\ba/?b[- ]test|\bexperimentation\b|\bsplit test"), ("Statistics", r"\bstatistic(?:s|al)\b|\bhypothesis test|\bregression\b"),
        ("Machine learning", r"\bmachine[- ]learning\b|\bml models?\b|\bpredictive model"), ("Forecasting", r"\bforecast(?:ing|s)?\b"),
        ("Cohorts & LTV", r"\bcohorts?\b|\bltv\b|lifetime value|\bchurn\b|\bretention analysis\b"),
        ("Experimentation platforms", r"\boptimizely\b|\bvwo\b|\blaunchdarkly\b|\bsplit\.io\b"), ("Dashboards", r"\bdata visuali[sz]|\bdashboards?\b"),
    ),
    "lang": (("English", r"\benglish\b|\bאנגלית\b"),),
}

CLUSTERS = (("sqldb", "SQL & Databases"), ("etl", "ETL & Infrastructure"), ("code", "Coding, ML & Statistics"), ("viz", "Visualization & BI"), ("other", "Other"))
CATEGORY_CLUSTER = {"query": "sqldb", "de": "etl", "cloud": "etl", "prog": "code", "bi": "viz", "method": "viz", "pa": "other"}
SKILL_CLUSTER = {"Machine learning": "code", "Statistics": "code", "A/B testing": "code", "Forecasting": "code", "Cohorts & LTV": "code", "Experimentation platforms": "code"}

FAMILIES = (
    ("Product Analyst", r"product analyst|game analyst"),
    ("Marketing Analyst", r"marketing analy|growth analyst|performance analyst|campaign analyst|ppc|paid (?:media|search|social)|monetization analyst|user acquisition"),
    ("BI & DWH", r"\bbi\b|business intelligence|dwh|data ?warehouse|tableau|power ?bi|qlik|analytics engineer"),
    ("Data Engineering", r"data engineer|etl developer|big data (?:developer|engineer)"),
    ("Data Science", r"data scien|machine learning|algorithm|\bml\b|\bai\b"),
    ("Product Manager", r"product manager|product owner|\bpm\b(?! ?o)"),
    ("Business Analyst", r"business analyst|business data analyst|process analyst|financial analyst|risk analyst|fraud analyst"),
    ("Data Analyst", r"data analyst|analytics|analyst"),
)
LEAD_TITLE = r"(?i)\b(team ?lead|tech ?lead|group ?lead|lead\b|manager|head of|principal|staff|director|vp|vice president|chief)\b"
YEARS = r"(?i)(\d{1,2})\s*\+?\s*(?:-\s*\d{1,2}\s*)?(?:years?|yrs?|שנות|שנים)\b"

SOFT_SKILLS = (
    ("Communication & storytelling", "communication", r"communicat|storytell|presentation skills|verbal and written|articulate|explain (?:complex|technical)|תקשורת"),
    ("Team player", "teamwork", r"team[- ]player|interpersonal|collaborative\b|works? well with|עבודת צוות"),
    ("Ownership & independence", "ownership", r"ownership|self[- ]motivat|independent(?:ly)?\b|autonomous|self[- ]starter|proactiv|initiative|end[- ]to[- ]end ownership|עצמא|יוזמה"),
    ("Business acumen", "acumen", r"business (?:acumen|sense|orient|understanding|mindset)|commercial (?:mindset|awareness)|הבנה עסקית"),
    ("Problem solving", "problemsolving", r"problem[- ]solv|critical think|analytical (?:mindset|thinking|skills)|creative think|פתרון בעיות|חשיבה אנליטית"),
    ("Attention to detail", "detail", r"attention to detail|detail[- ]oriented|meticulous|ירידה לפרטים|דייקנות"),
    ("Curiosity & learning", "curiosity", r"curiou?s|curiosity|(?:fast|quick) learner|self[- ](?:learn|taught)|eager to learn|growth mindset|סקרנ|לומד מהר"),
    ("Thrives in fast pace", "fastpaced", r"fast[- ]paced|dynamic environment|ambiguity|multi[- ]?task|prioriti[sz]|under pressure|tight deadlines|סביבה דינמית"),
    ("Leadership & mentoring", "leadership", r"leadership skills|mentor(?:ing|ship)?\b|coach(?:ing)?\b|lead (?:projects|initiatives|teams)|הובלה"),
)

TASK_GROUPS = (
    ("Instrument & manage tracking", "tracking", r"instrument|event[- ]track|tracking plan|taxonom|tagging|google tag manager|\bgtm\b|attribution setup"),
    ("Assure data quality", "quality", r"data quality|data integrit|cleans|validat|\bqa\b|audit|anomal|alert|data issues|accuracy|consistency|observabilit|govern|בקרת נתונים"),
    ("Run experiments & build models", "experiments", r"a/?b[- ]test|experiment|forecast|predict|machine[- ]learning|hypothes|simulat|build(?:ing)?\s+models?\b|(?:statistical|predictive|risk|churn|propensity|regression|scoring)\s+model\w*|מודל"),
    ("Define metrics & KPIs", "metrics", r"(?:defin|standardi[sz]|own|document)\w*[^.•]{0,45}(?:kpis?|metrics?)|metric specs?|single source of truth|north[- ]star|הגדרת מדדים"),
    ("Build pipelines & data models", "pipelines", r"pipeline|\betl\b|\belt\b|data model|warehouse|\bdbt\b|airflow|\bssis\b|semantic layer|modeled data|infrastructur|automat|integrat|ingest|תשתית"),
    ("Build dashboards & track performance", "reporting", r"dashboard|report(?:s|ing)?\b|visuali[sz]|scorecard|self[- ]serve|(?:track|monitor)\w*[^.•]{0,40}(?:performance|metrics?|kpis?|flows?)|monitor(?:ing)?\b|דוחות|דשבורד"),
    ("Analyze & recommend", "analysis", r"analy[sz]|insight|deep[- ]dive|dive deep|investigat|explor|research|uncover|identify[^.•]{0,40}(?:trend|opportunit|pattern|friction)|root[- ]cause|recommend|segment|cohort|funnel|ניתוח|תובנות|המלצ"),
    ("Partner & present", "partnering", r"stakeholder|present|communicat|partner|collaborat|cross[- ]functional|business (?:teams|units|leaders)|advis|translate|work (?:closely|with)|gather[^.•]{0,20}requirement|support (?:teams|the business)|ממשק|הצגה"),
)

DEGREE_LEVELS = (
    ("PhD", r"\bph\.?\s?d\b|\bdoctorate\b|תואר שלישי"),
    ("MSc", r"\bm\.?\s?sc\b|\bm\.?\s?a\b|\bmba\b|\bmaster(?:'?s)?\b|תואר שני"),
    ("BSc", r"\bb\.?\s?sc\b|\bb\.?\s?a\b|\bbachelor(?:'?s)?\b|תואר ראשון|\b(?:academic|university) degree\b|\bdegree in\b"),
)
DEGREE_HEDGE = r"(?i)advantage|a plus|preferred(?! fields?)|nice to have|desirable|bonus|יתרון"
DEGREE_FIELDS = (
    ("CS", r"computer science|מדעי המחשב"), ("Industrial Eng.", r"industrial engineering|הנדסת תעשייה|תעשייה וניהול"), ("Info Systems", r"information systems|מערכות מידע"),
    ("Statistics", r"statistics|סטטיסטיקה"), ("Economics", r"economics|כלכלה"), ("Math", r"mathematic|מתמטיקה"), ("Engineering", r"\bengineering\b|הנדסה"),
    ("Business", r"business (?:administration|management)|מנהל עסקים"), ("Finance", r"\bfinance\b|מימון|חשבונאות"), ("Life Sciences", r"life science|biolog|מדעי החיים"),
)

AI_USAGE = (
    ("AI for efficiency", "ai-efficiency", r"efficien|faster|productiv|streamlin|speed|improve (?:your |our |the )?workflows?|day[- ]to[- ]day|daily work|as part of your workflow"),
    ("AI for automation", "ai-automation", r"automat|agentic|auto[- ]generat|\bworkflows?\b"),
    ("Building with AI", "ai-building", r"build|develop|design|implement|creat\w+|deploy|enablement|integrat|semantic layer|fine[- ]?tun|\brag\b"),
)
AI_TOOL_WORDS = r"(?i)ai[- ]tools?|chatgpt|copilot|claude|cursor|ai[- ]assisted|llm[- ]based"
AI_MENTION = r"(?i)\bllms?\b|\bgen(?:erative)?\s?ai\b|\bgenai\b|\bai[- ]tools?\b|ai[- ]assisted|chatgpt|copilot|\bclaude(?: code)?\b|prompt[- ]?engineer\w*|context engineering|use of ai|leverag\w* (?:of )?ai\b|working with ai\b"
AI_PRODUCT = r"(?i)\bour (?:\w+ ){0,3}ai\b|company'?s ai|\bai[- ](?:powered|driven|native|first)\b|\bai (?:platform|product|solution|company|startup)|\bai agents?\b(?=[^.]{0,70}(?:perform|platform|product|secur|protect|identit|endpoint))"

# --- fixed values: sections of a description -------------------------------------------------------------------------
LABEL_PREFIX = r"(?i)^\s*(experience level\s*:[^.]*\.\s*)?(description\s*:\s*)?"
EXPERIENCE_LEVEL = r"(?i)experience level\s*:\s*([^.]+)"
REQUIREMENTS = (
    r"(?i)(requirements?|qualifications?|what (?:you.?ll|you will) (?:bring|need)|what are we looking for|what we.?re looking for|what we expect|"
    r"(?:perfect|ideal) job for someone who (?:has|is)|to thrive in this role,? you.?ll need|what you need to succeed|דרישות(?: התפקיד)?|מה אנחנו מחפשים|"
    r"כישורים נדרשים|what (?:will make|makes) you successful|who you are|about you|what we.?re looking for in you|must[- ]have|"
    r"your (?:profile|experience|background)|minimum qualifications|desired (?:skills|qualifications)|skills (?:&|and) (?:experience|qualifications)|"
    r"you(?:'?ll)? (?:have|bring))\s*:?"
)
SOFT_REQUIREMENTS = r"(?i)(ideal candidate|what you.?ll do|what you.?ll own)\s*:?"
SECTION_END = (
    r"(?i)(?:•\s*)?\b(responsibilit|benefits?|perks|about (?:us|the company)|why join|what we offer|we offer|our (?:stack|tech)|equal opportunit|"
    r"why you.?ll love|what makes\b|please (?:ensure|note)|founded in \d{4}|היקף משרה|אנחנו על המפה|קו\"ח|שעות עבודה)\b\s*:?"
)
PLUS_SECTION = (
    r"(?i)(?:•\s*)?\b(?:advantages?|nice[- ]to[- ]haves?|bonus(?: points)?(?: if you have)?|it would be (?:great|a plus)|preferred qualifications|"
    r"יתרון(?: משמעותי)? אם)\b\s*:"
)
PLUS_ONLY = r"(?i)^(?:advantages?|nice[- ]to[- ]haves?|bonus(?: points)?(?: if you have)?|preferred qualifications|יתרונות)\s*:?$"
LEADING_HEADER = r"(?i)^(responsibilities|requirements?|qualifications?|the role|about the role|role description|what you.?ll (?:need|bring|do|own))\s*:?\s*"
HEADER_ONLY = (
    r"(?i)^(experience|technical skills?|education|skills?|qualifications?|requirements?|nice to have|advantages?|bonus(?: points)?|about you|background|"
    r"responsibilities|what we(?:'re| are)? ?(?:expect|need|want|require|value|look\w*)|what you.?ll (?:need|do|bring|own|be doing)|technical|professional)"
    r"(?:\s*(?:&|and|/|,)\s*(?:experience|technical|skills?|education|qualifications?|requirements?|background))*\s*:?$"
)
SENTENCES = r"(?<=[a-z0-9%)א-ת])\.\s+(?=[A-Z0-9א-ת])|\s[–—]\s(?=[A-Z0-9])"
RUN_ON = (
    r"(?<=[a-zא-ת)%\.]) (?=(?:\d+\+? years?|Strong|Proven|Excellent|Experience|Experienced|Knowledge|Familiarity|Ability|Proficien\w*|Fluent|"
    r"High(?: proficiency| level)|Advanced|Deep|Solid|Hands[- ]on|Degree|B\.?Sc|M\.?Sc|Bachelor|Master|Team player|Self[- ]|Willingness|Availability|English|"
    r"Hebrew|Excellent|Very|Good|Great|At least|Minimum(?: of)?|Fluency|Fluent|ניסיון|תואר|ידע|יכולת|שליטה|אנגלית|היכרות|נכונות)\b)"
)
DASHES = r"\s+-\s+(?=[A-Z])(?!(?:Must|Mandatory|Requir|Advantage|Plus|Big|Nice|An?\b))"
#: One of these is in every text that LEADING_ or TRAILING_ patterns match.
BADGE_WORDS = r"(?i)must|mandatory|requir|חובה|advantage|nice to have|bonus|יתרון|plus|preferred"
LEADING_MUST = r"(?i)^\s*(?:must(?:[- ]haves?)?|mandatory|חובה)(?:\s*[-–—:]+\s*|\s+(?=[A-Zא-ת]))"
LEADING_PLUS = r"(?i)^\s*(?:advantage|nice to have|bonus|יתרון)\s*[-–—:]+\s*"
MUST_AT_END = r"(?i)(?:must(?:\s+have)?|mandatory|requir\w*|חובה)[.!)]?\s*$"
PLUS_AT_END = r"(?i)(?:advantage|plus|nice to have|preferred|bonus|יתרון(?: משמעותי)?)[.!)]?\s*$"
#: What may stand before them goes with them.
TRAILING_MUST = r"(?i)\s*[-–—(:]*\s*(?:a\s+)?" + MUST_AT_END.removeprefix("(?i)")
TRAILING_PLUS = r"(?i)\s*[-–—(:]*\s*(?:an?\s+)?(?:(?:big|strong|significant|major|huge|added|great|definite)\s+)?" + PLUS_AT_END.removeprefix("(?i)")
#: Beside what begins with #.
BULLET_JUNK = (
    r"(?i)https?://|www\.|#li-|\brésumé\b|resume(?:/cv)? you attach|why you.?ll love|equal opportunit|privacy policy|apply now|click here|"
    r"meet 100% of|not about checklists|encourage you to apply|describes you perfectly"
)
REQUIREMENT_SIGNAL = (
    r"(?i)\b(experience|years?|degree|proficien|knowledge|ability|familiar|proven|strong|expert|hands[- ]on|sql|python|excel|tableau|looker|power ?bi|"
    r"bachelor|master|fluent|understanding|background|skilled|passion|track record|mindset)\b"
)
DUTY_VERB = (
    r"(?i)^(develop|create|perform|build|design|lead|manage|work|partner|collaborate|own|drive|support|monitor|analy[sz]e|define|deliver|maintain|conduct|"
    r"translate|identify|provide|present|research|optimi[sz]e|execute|prepare|implement|serve|gather|track|run)\b"
)
DUTIES = (
    r"(?i)(responsibilit(?:ies|y)|what (?:you|you'?ll) (?:do|be doing|own|work on)|your (?:role|impact|day[- ]to[- ]day)|in this role,? you|role overview|"
    r"day[- ]to[- ]day|you will be|as part of (?:the|this) role|תחומי אחריות|מה תעשו|היומיום של)\s*:?"
)
RUN_ON_DUTIES = (
    r"(?<=[a-zא-ת)%.]) (?=(?:Develop|Create|Perform|Build|Design|Lead|Manage|Work|Partner|Collaborate|Own|Drive|Support|Monitor|Analy[sz]e|Define|Deliver|"
    r"Maintain|Conduct|Translate|Identify|Provide|Present|Research|Optimi[sz]e|Execute|Prepare|Implement|Serve|Gather|Track|Run|Ensure|ניתוח|בניית|עבודה|אחריות)\b)"
)
ROLE_MARKER = (
    r"(?i)(responsibilities|requirements|what you.?ll (?:do|be doing|bring)|qualifications|about the role|about the position|in this role|role overview|"
    r"your role|we.?re looking for|we are looking for|as an?\s|you will|what you bring)"
)
COMPANY_IS = r"(?i)\b(?:is|are)\s+(?:a|an|the)\s+(.{5,90}?)[\.\n;]"
#: What stands after a company's name in a sentence about it.
COMPANY_DOES = (
    r"[^.•]{0,40}?\b(?:is|are|builds?|provides?|offers?|powers?|helps?|enables?|delivers?|develops?|creates?|makes?)\s+"
    r"(?!seeking|looking|hiring|searching|recruiting|excited|thrilled|proud|now\b)(?:(?:a|an|the)\s+)?(.{6,110}?)[.•\n;]"
)
BLURB_STRAYS = ("of", "to", "for", "and", "or", "with", "that", "which", "by", "from", "as", "but", "nor")
BLURB_JUNK = (
    r"(?i)not logged in|please run|/login|usage:|command not found|invalid api|api key|traceback|rate limit|quota|unauthor|permission denied|"
    r"\bI['’]?m\b|\bI\s+(?:don['’]?t|do not|can['’]?t|cannot|couldn['’]?t|am|have|would|need|recommend)\b|\bI['’]d\b|"
    r"unable to (?:confirm|verify)|no (?:job post )?context was provided|web[- ]search access"
)
MANGLED_TITLE = r"(?i)[⋅•·|►▸]|,\s*israel\b|tel[\s-]?aviv,|(?<=[a-z])(?:Tel Aviv|Israel|Apply|Remote|Full[\s-]?time)|israel(?=[A-Za-z])"
SECTION_MARKERS = (
    r"(requirements?|responsibilit|qualifications?|experience|what you.?ll|we.?re looking|about the (?:role|job|position)|skills|full[- ]time|"
    r"דרישות|אחריות|ניסיון|תיאור (?:ה)?משרה|כישורים)"
)
EMPLOYMENT = (("maternity", "Maternity cover"), ("temporary", "Temp"), ("contract", "Contract"), ("internship", "Intern"), ("part-time", "Part-time"))
SENIOR_WORDS = r"(?i)\b(senior|sr\.?|principal|staff|head of|lead|director|vp|chief|expert|manager)\b"
LEAD_WORDS = r"(?i)\b(team ?lead|tech ?lead|group lead|manager|head of|principal|staff|director|vp|vice president|chief)\b"

# --- fixed values: pages ---------------------------------------------------------------------------------------------
TITLE_KEYS = ("title", "jobtitle", "positiontitle", "position_title", "name", "role", "rolename", "postingtitle", "posting_title", "displayname", "display_name", "jobname")
LOCATION_KEYS = (
    "location", "locations", "office", "offices", "city", "joblocation", "job_location", "location_display_name", "locationname", "primarylocation",
    "locationstext", "addresslocality", "location_name", "officelocation", "cities",
)
URL_KEYS = (
    "url", "absolute_url", "joburl", "job_url", "apply_url", "applyurl", "link", "href", "canonicalurl", "externalpath", "positionurl", "detailurl",
    "landing_page", "hitlink",
)
ID_KEYS = ("id", "jobid", "job_id", "reqid", "req_id", "requisitionid", "shortcode", "displayjobid", "ffid", "slug", "pid", "gh_id")
DATE_KEYS = (
    "dateposted", "date_posted", "postedon", "posted_on", "publisheddate", "created_at", "postedts", "creationts", "updated_at", "firstpublished", "posting_date",
)
TEXT_KEYS = ("name", "text", "label", "value", "location_display_name", "display_name", "addressLocality", "title")
BAD_TITLE = r"(?i)^(home|careers?|jobs?|about|search|apply|menu|cookie|privacy|all|view|open positions|see all|load more|next|previous)$"
TITLE_JUNK = (
    r"(?i)[⋅•·|►▸]|,\s*israel\b|tel[\s-]?aviv,|\bis looking for\b|\bwe(?:'re| are) looking\b|\bwe are seeking\b|posted\s+\d|"
    r"(?<=[a-z])(?:Tel Aviv|Israel|Herzliya|Haifa|Ra'?anana|Petah|Apply|Remote|Hybrid|Full[\s-]?time|View job|Learn more)|israel(?=[A-Za-z])"
)
ROLE_WORDS = (
    r"(?i)engineer|developer|manager|analyst|scientist|designer|\blead\b|architect|specialist|director|\bhead\b|officer|consultant|researcher|marketing|"
    r"sales|product|\bdata\b|devops|\bqa\b|account|recruit|finance|legal|operations|support|success|counsel|controller|analytics|intern|associate|"
    r"representative|coordinator|administrator|strategist|writer|editor|producer|planner|buyer|technician|expert|advisor|\bpartner\b|evangelist|advocate|"
    r"programmer|\bsre\b|\bux\b|\bui\b|scrum|agile|automation|solution|business|operation|team\s+lead|full[\s-]?stack|back[\s-]?end|front[\s-]?end|"
    r"principal|staff|vp\b|chief|president|counsel|paralegal|accountant|bookkeeper|generalist"
)
POSTING_PATH = r"(?i)/(job|jobs|position|opening|vacancy|role)s?[/\-_=?]|gh_jid=|/apply\b"
HEBREW_PLACES = (r"ישראל", r"תל[\s-]?אביב", r"חיפה", r"באר[\s-]?שבע", r"רעננה", r"הרצליה", r"ירושלים", r"פתח[\s-]?תקווה")
#: Platform, a pattern whose first group is the board's token, and the address of its list.
BOARD_SIGNATURES = (
    ("greenhouse", r"(?i)greenhouse\.io/embed/job_board/js\?for=([a-z0-9_-]+)", "https://boards-api.greenhouse.io/v1/boards/{}/jobs"),
    ("greenhouse", r"(?i)boards\.greenhouse\.io/(?:embed/job_board\?for=)?([a-z0-9_-]+)", "https://boards-api.greenhouse.io/v1/boards/{}/jobs"),
    ("lever", r"(?i)jobs\.lever\.co/([A-Za-z0-9_-]+)", "https://api.lever.co/v0/postings/{}?mode=json"),
    ("ashby", r"(?i)jobs\.ashbyhq\.com/([A-Za-z0-9_-]+)", "https://api.ashbyhq.com/posting-api/job-board/{}"),
    ("recruitee", r"(?i)([a-z0-9-]+)\.recruitee\.com", "https://{}.recruitee.com/api/offers/"),
    ("workable", r"(?i)apply\.workable\.com/(?:api/v1/widget/accounts/)?([a-z0-9-]+)", "https://apply.workable.com/api/v1/widget/accounts/{}?details=true"),
    ("smartrecruiters", r"(?i)careers\.smartrecruiters\.com/([A-Za-z0-9]+)", "https://api.smartrecruiters.com/v1/companies/{}/postings"),
    ("breezy", r"(?i)([a-z0-9-]+)\.breezy\.hr", "https://{}.breezy.hr/json"),
    ("bamboohr", r"(?i)([a-z0-9]+)\.bamboohr\.com", "https://{}.bamboohr.com/careers/list"),
)
WORKDAY_SITE = r"https?://([a-z0-9]+)\.(wd\d+)\.myworkdayjobs\.com/(?:[a-z]{2}-[A-Z]{2}/)?([A-Za-z0-9_]+)"
SCRIPT_BLOBS = (
    r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>""", r"""(?is)<script[^>]*type=["']application/json["'][^>]*>(.*?)</script>""",
    r"""(?is)<script[^>]*id=["']__NEXT_DATA__["'][^>]*>(.*?)</script>""",
)
PAGE_LINK = r"""(?is)<a[^>]+href=["']([^"']+)["'][^>]*>(.{5,140}?)</a>"""
CARD_HEADING = r"(?i)<(h[1-4])([^>]*)>([^<]{5,90})</\1>"
CARD_CLASS = r"""(?i)<(p|div|span|a)([^>]*class=["'][^"']*(?:job|position|role|opening)[^"']*(?:title|name|copy)[^"']*["'][^>]*)>([^<]{5,90})</\1>"""
SENTENCE_START = r"(?i)^(we|our|join|about|why|what|how|let)\b"
JOBS_LANGUAGE = r"(?i)open position|current opening|job opening|apply now|we'?re hiring|view (all )?jobs|join our team|משרות|דרושים|הצטרפו"
ROLE_PHRASE = r"[A-Z][A-Za-z/&+.\- ]{3,44}\b(?:Engineer|Analyst|Manager|Developer|Scientist|Designer|Architect|Specialist|Lead|Director|Researcher|Consultant|Associate)\b"
ACQUIRED = r"(?i)(is |has been |was )?(now )?(part of|acquired by|joins?|joining) ([A-Z][A-Za-z0-9.\- ]{2,30})|acquisition of|we(?:'| a)re now ([A-Z][A-Za-z0-9.\- ]{2,30})"
JOB_REQUEST = r"""(?i)(api|graphql)[^"']*(job|position|opening|career|search)|(job|position|opening)[^"']*(api|json)"""
JOB_SIGNS = r"(?i)apply now|open position|current opening|we'?re hiring|job opening|משרות|דרושים|careers-position|/job/|jobs/search"
PLACE_SIGNS = r"(?i)israel|tel[\s-]?aviv|herzliya|haifa|petah|ramat[\s-]?gan|beer[\s-]?sheva"
JUNIOR_POSTS = ("ללא ניסיון", "סטודנט", "משרת סטודנט", "junior")
