"""Fixed values of the semantics being matched, in one place."""

# fixed values: these must stay equal to the behaviour being reproduced
DEFAULT_THRESHOLD = 2.0           # percent, when a subscription has none
MIN_THRESHOLD = 0.1               # percent, smallest accepted subscription threshold
MAX_THRESHOLD = 50.0              # percent, largest accepted subscription threshold
POSITIVE_ABOVE = 0.1              # sentiment score above this is "positive"
NEGATIVE_BELOW = -0.1             # sentiment score below this is "negative"
COOLDOWN_SECONDS = 3600           # per-coin alert cooldown
BUCKET_WIDTH = "30 minutes"       # price history resolution
RANGE_PADDING = 0.02              # axis padding of price panels
SPARKLINE_PADDING = 0.15          # axis padding of sparklines
FLAT_RANGE_FRACTION = 0.01        # padding of a flat series, as a fraction of its value
VOLUME_UNIT = 1e9                 # volumes are shown in billions
ARTICLES_PER_COIN = 10            # newest articles kept per coin and poll
ARTICLE_LANGUAGE = "en"           # language of selected articles
UNKNOWN_SOURCE = "unknown"        # source name when an article has none
DROP_FORM_LABEL = "Drops by"      # form choice meaning direction "drop"
DROP_SUBJECT_VERB = "dropped"     # alert subject, by direction
RISE_SUBJECT_VERB = "surged"
DROP_BODY_VERB = "dropped"        # alert body, by direction
RISE_BODY_VERB = "risen"
THRESHOLD_PHRASE = "Your threshold"
TICK_TRIGGER = "30 seconds"       # tick micro-batch trigger
SENTIMENT_TRIGGER = "60 seconds"  # article micro-batch trigger
