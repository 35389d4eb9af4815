"""Values that have to be exactly these for results to come out right.

Everything here is a default; each operator takes its own value as an argument.
"""

# --- fixed values -----------------------------------------------------------

# Words left out of every word count.
STOPWORDS = tuple(
    """
    a about above after again against all am an and any are aren't as at
    be because been before being below between both but by can't cannot could
    couldn't did didn't do does doesn't doing don't down during each few for
    from further had hadn't has hasn't have haven't having he he'd he'll he's
    her here here's hers herself him himself his how how's i i'd i'll i'm
    i've if in into is isn't it it's its itself let's me more most mustn't
    my myself no nor not of off on once only or other ought our ours ourselves
    out over own same shan't she she'd she'll she's should shouldn't so some such
    than that that's the their theirs them themselves then there there's these they
    they'd they'll they're they've this those through to too under until up very
    was wasn't we we'd we'll we're we've were weren't what when where which
    while who whom why with won't would you you'd you'll you're you've your
    yours yourself yourselves us rt p dont will ... - s t u 4 11 m 47 50
    &amp; &amp amp 9
    """.split()
)

# Topics: a post belongs to a topic if a tag holds one of its needles.
TOPIC_NEEDLES = {"obama": ("obama", "obama2012"), "romney": ("romney",)}

# Zones that count as the USA.
USA_ZONE_PATTERN = "%US & Canada%"

# Sentiment labels for a positive, negative and zero score.
POSITIVE, NEGATIVE, NEUTRAL = "positivo", "negativo", "neutro"

# `created_at` after its four leading characters (weekday and blank).
CREATED_AT_FORMAT = "MMM dd HH:mm:ss Z yyyy"
WEEKDAYS = ("mon ", "tue ", "wed ", "thu ", "fri ", "sat ", "sun ")

# A link in lower-case text. Letters and digits of any script count as word characters.
LINK_PATTERN = r"https?:(?://|\\)++(?:[\p{L}\p{N}_:#@%/;$()~?+-=\\.&](?:#!)?)*+"

# ASCII punctuation that separates words; `@` and `#` do not, they start an entity.
SEPARATORS = "!\"$%&'()*+,-./:;<=>?[\\]^_`{|}~"

# Blanks, as regex classes: as the word counter knows them (ASCII), and as the cleaner
# knows them (any script).
ASCII_BLANK = r"\s"
ANY_BLANK = r"\t-\r\x1c- \x85\p{Z}"

# Report sizes.
TOP_WORDS = 15
TOP_VERTICES = 10
HISTOGRAM_BINS = 50
