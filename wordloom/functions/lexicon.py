"""Word lists. They decide the results and are shared with the SQL checks."""

# Spark's own English stop words (StopWordsRemover), the default stop list.
ENGLISH = tuple(
    """
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
    """.split()
)

# Filler words of spoken transcripts. The two-word ones can never equal a token
# and are kept because the list is given that way.
FILLERS = (
    "um", "uh", "like", "you know", "so", "actually", "basically",
    "i mean", "kind of", "sort of", "well", "okay",
)
FILLERS_WITH_RIGHT = FILLERS + ("right",)

# Contractions that a Treebank tokeniser splits without an apostrophe.
CONTRACTIONS = (
    ("cannot", ("can", "not")),
    ("gimme", ("gim", "me")),
    ("gonna", ("gon", "na")),
    ("gotta", ("got", "ta")),
    ("lemme", ("lem", "me")),
    ("wanna", ("wan", "na")),
)

# Opinion words, the default of the label operator; replaced by the caller's own table.
POSITIVE = tuple(
    """
    accurate amazing awesome beautiful benefit best better brilliant calm clean clear comfortable correct delighted
    easy effective efficient enjoy enjoyed excellent fast favorite fine friendly fun glad good grateful great happy
    helpful ideal impressive improved kind love loved nice perfect pleasant pleased positive quick reliable resolved
    safe satisfied smooth solved strong succeed success successful superb thank thanks useful welcome wonderful
    """.split()
)
NEGATIVE = tuple(
    """
    afraid angry annoyed annoying awful bad boring broken complaint confused confusing crash crashed damage damaged
    dangerous defect delay delayed difficult disappointed dislike error errors fail failed failure fault faulty hate
    horrible hurt incorrect lost mistake mistakes negative pain painful poor problem problems rude sad slow sorry
    stuck stupid terrible trouble ugly unable unclear unhappy unsafe useless weak worse worst wrong
    """.split()
)
POLARITY = tuple((word, 1) for word in POSITIVE) + tuple((word, -1) for word in NEGATIVE)
