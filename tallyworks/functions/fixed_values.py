"""Values that results depend on, stated as they are. All of them can be replaced by arguments."""

# Texts that a CSV reader takes for a missing value (pandas' documented defaults).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Severity 0..5 of each charge degree.
CHARGE_SEVERITY = {
    "(0)": 0, "(M2)": 1, "(M1)": 2, "(F3)": 3, "(F2)": 4, "(F1)": 5,
    "(MO3)": 1, "(TCX)": 1, "(F7)": 4, "(NI0)": 0, "(TC4)": 2, "(X)": 1,
    "(CO3)": 1, "(F5)": 4, "(M3)": 1, "XXXXXXXXXX": 0, "(CT)": 1, "(F6)": 5,
}

# Topic patterns looked for in charge texts.
CHARGE_TOPICS = {
    "alcohol": "Drink|Alcohol|Intoxicat|Bev|Drunk|DOC",
    "road_traffic": "License|Driv|Vehicle|Racing|DL",
    "tobacco": "Tobacco|Smoke",
    "under_18": "(?=.*Under)(?=.*18)",
    "driving_influence": "(?=.*Driving)(?=.*Influence)",
    "driving_intoxicated": "DWI",
    "reckless_driving": "(?=.*Reckles)(?=.*Driving)",
    "burglary": "Burglary",
    "armed_burglary": "(?=.*Burglary)(?=.*Armed)",
    "assault_burglary": "(?=.*Burglary)(?=.*Assault)",
    "dwelling_burglary": "(?=.*Burglary)(?=.*Dwelling)",
    "sexual_battery": "(?=.*Sex)(?=.*Battery)",
    "contempt": "Contempt",
    "first_degree_murder": "(?=.*Murder)(?=.*First)",
}

# Bin edges (right-closed) and labels of the age and charge-number groups.
AGE_EDGES = [20, 30, 40, 50, 60]
AGE_LABELS = ["<20", "20-30", "30-40", "40-50", "50-60", ">60"]
CHARGE_NUMBER_EDGES = [1, 2, 3, 4, 5]
CHARGE_NUMBER_LABELS = ["1", "2", "3", "4", "5", ">5"]

# Day types that count as a holiday, and what stands for no holiday.
HOLIDAY_TYPES = ["Transfer", "Additional", "Bridge", "Event", "Holiday"]
NO_HOLIDAY_FILL = {
    "day_type": "Work Day",
    "locale": "No Holiday",
    "locale_name": "No Holiday",
    "description": "No Holiday",
    "transferred": False,
}

# Start and length of the event period, centre and neighbouring states.
EVENT_START, EVENT_DAYS = "2016-04-16", 90
EVENT_CENTRE = ["Esmeraldas", "Esmaraldas"]
EVENT_NEIGHBOURS = ["Pichincha", "Imbabura", "Santo Domingo de los Tsachilas", "Manabi"]

# Score labels in the order of the result tables.
EMOTIONS = ["sadness", "anger", "fear", "love", "joy", "surprise"]

# Entity labels that name a place or a people.
PLACE_LABELS = ["NORP", "GPE", "LOC"]

# Element that holds the article, by host: tag, attribute, value, which match.
ARTICLE_RULES = [
    ("us-cert.cisa.gov", "div", "class",
     "field field--name-body field--type-text-with-summary field--label-hidden field--item", 4),
    ("www.cisecurity.org", "div", "class", "template-main-content", 0),
    ("www.darkreading.com", "script", "type", "application/ld+json", 0),
    ("cyber.gc.ca", "div", "class",
     "field field--name-body field--type-text-with-summary field--label-hidden field--item", 0),
    ("www.techtarget.com", "section", "id", "content-body", 0),
    ("gbhackers.com", "div", "class", "td-post-content", 0),
    ("www.cshub.com", "div", "class", "mb-3", 0),
    ("www.secureworks.com", "div", "class", "dashed", 0),
    ("www.welivesecurity.com", "div", "class", "col-md-10 col-sm-10 col-xs-12 formatted", 0),
]

# Phrases between two entity marks that state a sub-group, and the side of the
# general term ("first" or "last"), in the order in which they are tried.
IS_A_RULES = [
    (r"(NP_\w+ (, )?such as (NP_\w+ ?(, )?(and |or )?)+)", "first"),
    (r"(such NP_\w+ (, )?as (NP_\w+ ?(, )?(and |or )?)+)", "first"),
    (r"((NP_\w+ ?(, )?)+(and |or )?other NP_\w+)", "last"),
    (r"(NP_\w+ (, )?include (NP_\w+ ?(, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ (, )?especially (NP_\w+ ?(, )?(and |or )?)+)", "first"),
    (r"((NP_\w+ ?(, )?)+(and |or )?any other NP_\w+)", "last"),
    (r"((NP_\w+ ?(, )?)+(and |or )?some other NP_\w+)", "last"),
    (r"((NP_\w+ ?(, )?)+(and |or )?be a NP_\w+)", "last"),
    (r"(NP_\w+ (, )?like (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"such (NP_\w+ (, )?as (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"((NP_\w+ ?(, )?)+(and |or )?like other NP_\w+)", "last"),
    (r"((NP_\w+ ?(, )?)+(and |or )?one of the NP_\w+)", "last"),
    (r"((NP_\w+ ?(, )?)+(and |or )?one of these NP_\w+)", "last"),
    (r"((NP_\w+ ?(, )?)+(and |or )?one of those NP_\w+)", "last"),
    (r"example of (NP_\w+ (, )?be (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"((NP_\w+ ?(, )?)+(and |or )?be example of NP_\w+)", "last"),
    (r"(NP_\w+ (, )?for example (, )?(NP_\w+ ?(, )?(and |or )?)+)", "first"),
    (r"((NP_\w+ ?(, )?)+(and |or )?which be call NP_\w+)", "last"),
    (r"((NP_\w+ ?(, )?)+(and |or )?which be name NP_\w+)", "last"),
    (r"(NP_\w+ (, )?mainly (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ (, )?mostly (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ (, )?notably (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ (, )?particularly (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ (, )?principally (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ (, )?in particular (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ (, )?except (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ (, )?other than (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ (, )?e.g. (, )?(NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ \( (e.g.|i.e.) (, )?(NP_\w+ ? (, )?(and |or )?)+(\. )?\))", "first"),
    (r"(NP_\w+ (, )?i.e. (, )?(NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"((NP_\w+ ?(, )?)+(and|or)? a kind of NP_\w+)", "last"),
    (r"((NP_\w+ ?(, )?)+(and|or)? kind of NP_\w+)", "last"),
    (r"((NP_\w+ ?(, )?)+(and|or)? form of NP_\w+)", "last"),
    (r"((NP_\w+ ?(, )?)+(and |or )?which look like NP_\w+)", "last"),
    (r"((NP_\w+ ?(, )?)+(and |or )?which sound like NP_\w+)", "last"),
    (r"(NP_\w+ (, )?which be similar to (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ (, )?example of this be (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ (, )?type (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"((NP_\w+ ?(, )?)+(and |or )? NP_\w+ type)", "last"),
    (r"(NP_\w+ (, )?whether (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(compare (NP_\w+ ?(, )?)+(and |or )?with NP_\w+)", "last"),
    (r"(NP_\w+ (, )?compare to (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"(NP_\w+ (, )?among -PRON- (NP_\w+ ? (, )?(and |or )?)+)", "first"),
    (r"((NP_\w+ ?(, )?)+(and |or )?as NP_\w+)", "last"),
    (r"(NP_\w+ (, )? (NP_\w+ ? (, )?(and |or )?)+ for instance)", "first"),
    (r"((NP_\w+ ?(, )?)+(and|or)? sort of NP_\w+)", "last"),
    (r"(NP_\w+ (, )?which may include (NP_\w+ ?(, )?(and |or )?)+)", "first"),
]

# The strings of tagged triple output.
TRIPLE_MARK, OBJECT_MARK, RELATION_MARK = "<triplet>", "<subj>", "<obj>"
SEQUENCE_MARKS = ["<s>", "</s>", "<pad>"]
