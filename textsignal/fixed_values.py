"""Patterns, word lists and default parameters that decide the results.

They are stated here once, in the order in which they are applied. Everything that reads
like a setting (subjects, window sizes, thresholds, split weights) is also an argument of
the function that uses it.
"""

# --- show name from a file path -------------------------------------------------------
# Parent folder of a path that ends in `.ext`, otherwise the last path element.
PATH_NAME = r"/([^/]+?)(?:/[^/]+?\.[a-z]+?$|$)"
ESCAPED_SPACE = "%20"
NOT_NAME_CHARACTER = r"[^a-zA-Z0-9\s]"

# --- transcript cleaning, in this order -----------------------------------------------
CLOCK_MARK = r"\[\d{2}:\d{2}:\d{2}\]|\d{2}:\d{2}"
FREE_NUMBER = r"\b\d+\b"
NOT_WORD_CHARACTERS = r"[^a-zA-Z0-9\s]+"
SPOKEN_DURATION = r"\b\d+m\s*\d+s|\b\d+s"

# --- tokens ---------------------------------------------------------------------------
TOKEN_GAP = r"\s+"
BLANK_CHARACTERS = " \t\n\x0b\f\r"  # a token of nothing else is blank

# --- clean-up of text that goes into a labelling prompt -------------------------------
# White space of any script counts as a gap between words, and so do the four separators.
ANY_SPACE = r"\p{IsWhite_Space}\x1C-\x1F"
PROMPT_PASSAGE = "\n        Segment: "  # between the instruction and the passage
REPLY_FRAME = ("<s>[INST] ", " [/INST]")  # what some models put around the prompt they echo
PROMPT_RESERVE = 400  # room for the reply on top of the words of the prompt
BUDGET_STEP = 100  # added to the budget after every failed attempt

# --- parsing of replies ---------------------------------------------------------------
REPLY_RATING = r"(\d\.\d+)"
REPLY_NEUTRAL_WORDS = ("Neutral", "both", "neutral")

# --- default sizes --------------------------------------------------------------------
SEGMENT_TOKENS = 200
CONTEXT_RADIUS = 100
VOCABULARY_SIZE = 100
VOCABULARY_MIN_DOCUMENTS = 3
TOPICS = 5
TOPIC_ITERATIONS = 10
TOPIC_TERMS = 5
EMBEDDING_SIZE = 100
EMBEDDING_PARTITIONS = 8  # parts trained on their own, at least; word vectors depend on their number
CONTEXT_WORDS = 5  # on each side of a word, for counted word vectors
NEUTRAL_LABEL = 0.5
HISTOGRAM_BINS = 50

# --- default search grids -------------------------------------------------------------
FOREST_GRID = {"numTrees": [10, 20, 50], "maxDepth": [5, 10, 20], "maxBins": [32, 64]}
LINEAR_GRID = {
    "regParam": [0.1, 0.01],
    "fitIntercept": [False, True],
    "elasticNetParam": [0.0, 0.5, 1.0],
}
FOLDS = 5

# --- default English stop words of Spark's StopWordsRemover, in its order -------------
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what
    which who whom this that these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of at by for
    with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so than too
    very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd
    you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
    you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't
    didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
    how's let's ought that's there's what's when's where's who's why's would
    """.split()
)
