"""Fixed values. They have to equal the values of the original analysis for equal results."""

# Phrases that stand for "nothing to say", compared stripped and lower-cased.
POSITIVE_PLACEHOLDERS = ("no positive", "nothing", "n a", "na", "none")
NEGATIVE_PLACEHOLDERS = ("no negative", "nothing", "n a", "na", "none")

# Strings a CSV field may hold for "missing" (the documented pandas defaults).
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The search queries used when none are given.
DEFAULT_QUERIES = (
    "dirty room and noisy street",
    "friendly staff and great location",
    "small bathroom and old furniture",
    "excellent breakfast and comfortable bed",
    "slow wifi and poor service",
    "good hotel",
)

# Spark's own English stop words (StopWordsRemover.loadDefaultStopWords("english")),
# written out so that the list is known without a session. Any other list can be passed instead.
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split())
