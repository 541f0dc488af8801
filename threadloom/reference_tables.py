"""Word lists, lookup tables, constants and patterns, kept in one place.

Larger tables (base stop words, lexicon, lemmas) are parameters: the base stop
words default to the list Spark ships, lexicon and lemmas are read as tables.
"""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover

# ---------------------------------------------------------------------------
# They have to equal the published ones for right results.
# ---------------------------------------------------------------------------

# Contractions in table order. The order decides which alternative of a shared
# prefix is reached first.
CONTRACTIONS = {
    "ain't": "am not",
    "aren't": "are not",
    "can't": "cannot",
    "can't've": "cannot have",
    "'cause": "because",
    "could've": "could have",
    "couldn't": "could not",
    "couldn't've": "could not have",
    "didn't": "did not",
    "doesn't": "does not",
    "don't": "do not",
    "hadn't": "had not",
    "hadn't've": "had not have",
    "hasn't": "has not",
    "haven't": "have not",
    "he'd": "he would",
    "he'd've": "he would have",
    "he'll": "he will",
    "he'll've": "he will have",
    "he's": "he is",
    "how'd": "how did",
    "how'd'y": "how do you",
    "how'll": "how will",
    "how's": "how is",
    "i'd": "I would",
    "i'd've": "I would have",
    "i'll": "I will",
    "i'll've": "I will have",
    "i'm": "I am",
    "i've": "I have",
    "isn't": "is not",
    "it'd": "it had",
    "it'd've": "it would have",
    "it'll": "it will",
    "it'll've": "it will have",
    "it's": "it is",
    "let's": "let us",
    "ma'am": "madam",
    "mayn't": "may not",
    "might've": "might have",
    "mightn't": "might not",
    "mightn't've": "might not have",
    "must've": "must have",
    "mustn't": "must not",
    "mustn't've": "must not have",
    "needn't": "need not",
    "needn't've": "need not have",
    "o'clock": "of the clock",
    "oughtn't": "ought not",
    "oughtn't've": "ought not have",
    "shan't": "shall not",
    "sha'n't": "shall not",
    "shan't've": "shall not have",
    "she'd": "she would",
    "she'd've": "she would have",
    "she'll": "she will",
    "she'll've": "she will have",
    "she's": "she is",
    "should've": "should have",
    "shouldn't": "should not",
    "shouldn't've": "should not have",
    "so've": "so have",
    "so's": "so is",
    "that'd": "that would",
    "that'd've": "that would have",
    "that's": "that is",
    "there'd": "there had",
    "there'd've": "there would have",
    "there's": "there is",
    "they'd": "they would",
    "they'd've": "they would have",
    "they'll": "they will",
    "they'll've": "they will have",
    "they're": "they are",
    "they've": "they have",
    "to've": "to have",
    "wasn't": "was not",
    "we'd": "we had",
    "we'd've": "we would have",
    "we'll": "we will",
    "we'll've": "we will have",
    "we're": "we are",
    "we've": "we have",
    "weren't": "were not",
    "what'll": "what will",
    "what'll've": "what will have",
    "what're": "what are",
    "what's": "what is",
    "what've": "what have",
    "when's": "when is",
    "when've": "when have",
    "where'd": "where did",
    "where's": "where is",
    "where've": "where have",
    "who'll": "who will",
    "who'll've": "who will have",
    "who's": "who is",
    "who've": "who have",
    "why's": "why is",
    "why've": "why have",
    "will've": "will have",
    "won't": "will not",
    "won't've": "will not have",
    "would've": "would have",
    "wouldn't": "would not",
    "wouldn't've": "would not have",
    "y'all": "you all",
    "y'alls": "you alls",
    "y'all'd": "you all would",
    "y'all'd've": "you all would have",
    "y'all're": "you all are",
    "y'all've": "you all have",
    "you'd": "you had",
    "you'd've": "you would have",
    "you'll": "you will",
    "you'll've": "you will have",
    "you're": "you are",
    "you've": "you have",
}

# The shorter list of the emotion scorer, applied one after the other.
SCORER_CONTRACTIONS = {
    "don't": "do not",
    "can't": "cannot",
    "won't": "will not",
    "isn't": "is not",
    "aren't": "are not",
    "wasn't": "was not",
    "weren't": "were not",
    "haven't": "have not",
    "hasn't": "has not",
    "hadn't": "had not",
    "wouldn't": "would not",
    "shouldn't": "should not",
    "couldn't": "could not",
    "i'm": "i am",
    "you're": "you are",
    "it's": "it is",
    "that's": "that is",
    "we're": "we are",
    "they're": "they are",
    "i've": "i have",
    "you've": "you have",
    "we've": "we have",
    "they've": "they have",
    "i'll": "i will",
    "you'll": "you will",
    "he'll": "he will",
    "she'll": "she will",
    "we'll": "we will",
    "they'll": "they will",
}

CUSTOM_STOPS = [
    "<cmt>", "[deleted]", "amp", "http", "https", "edit", "deleted", "thing",
    "stuff", "really", "just", "like", "thanks", "lol", "im", "dont", "ive",
    "youre", "thats",
]

DOMAIN_STOPS = [
    "gpt", "chatgpt", "codex", "claude", "openai", "anthropic", "llm", "ai",
    "work", "time", "user", "people", "person", "post", "new", "need", "way",
    "model", "code", "someth", "peopl", "whi", "becaus", "tri", "actual",
    "know", "think", "want", "make", "say", "said", "tell", "come", "look",
    "use", "thing", "year", "day", "month", "week", "get", "got", "go", "went",
    "see", "seen", "feel", "felt", "help", "try", "start", "end", "give", "take",
    "find", "found", "seem", "believe", "understand", "mean", "happen", "turn",
    "keep", "put", "call", "ask", "let", "leave", "move", "show", "bring",
    "like", "just", "realli", "didn", "ll", "weren", "ve", "don", "im",
    "anyon", "doe", "similar", "situat", "kind", "reddit", "thread", "comment",
    "subreddit", "upvote",
]

# The topic model drops these four on top of DOMAIN_STOPS.
TOPIC_EXTRA_STOPS = ["the", "here", "for", "was"]

ASCII_PUNCTUATION = list("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

MARKERS = ["[deleted]", "[removed]"]
COMMENT_SEPARATOR = " <cmt> "
BOILERPLATE = "automoderator|suicidewatch|national hotline|message/compose"

# normaliser
CURLY = "’“”–—"
STRAIGHT = "'\"\"--"
NORMALISER_TRIM = ".,!?:;*()[]{}\"'–-—/\\"
NORMALISER_JUNK = [
    "[text]", "[image]", "[removed]", "[deleted]", "redirected", "fool49",
    "faq", "summary__", "__extended", "mega", "topics",
]
NORMALISER_FRAGMENTS = ["http", "reddit.com", "message/compose"]
NORMALISER_LITERALS = ["cmt", "discussion", "text"]
UNITS = ["mg", "mcg", "bpm", "kg", "lbs", "%"]
KEEP_SHORT = ["ecg", "sad", "ptsd", "mom", "dad", "anx"]

# simple tokenizer
TOKENIZER_TRIM = ".,!?:;()[]{}\"'-–—/\\"
TOKENIZER_JUNK = ["[text]", "[image]", "[removed]", "[deleted]"]

# emotion scorer
EMOTIONS = [
    "anger", "anticipation", "disgust", "fear", "joy", "sadness", "surprise",
    "trust", "negative", "positive",
]
EMOTION_WEIGHTS = {
    "fear": 1.0,
    "sadness": 0.7,
    "anger": 0.6,
    "disgust": 0.6,
    "anticipation": 0.4,
    "surprise": 0.3,
    "joy": -0.5,
    "trust": -0.4,
    "negative": 0.3,
    "positive": -0.2,
}
NEGATORS = ["no", "not", "never", "without", "hardly", "none", "neither", "nor"]
INTENSIFIERS = [
    "very", "extremely", "super", "so", "highly", "really", "quite", "totally",
]

# labelling limits
MAX_TITLE = 200
MAX_TEXT = 1000
MAX_PROMPT_TOKENS = 3000
TRUNCATION_MARK = "...[truncated]..."

# words left out of the label word counts
LABEL_NOISE = [
    "sayin", "really", "even", "long", "says", "photo", "thought", "am", "ive",
    "cant", "arent", "but", "will", "before", 'would, "context"',
]

PERMALINK_HOST = "https://www.reddit.com"

# ---------------------------------------------------------------------------
# Own defaults
# ---------------------------------------------------------------------------

PROMPT_TEMPLATE = (
    "Rate the following forum post from group %1$s.\n"
    "Title: %2$s\n"
    "Text: %3$s\n"
    "Answer with one JSON object holding category (ANXIETY or NOT_ANXIETY), "
    "severity (0-5) and confidence (0.0-1.0)."
)


def base_stop_words() -> list[str]:
    """Spark's English list with the custom and domain words added.

    Needs an active session, because the list is read from the JVM.
    """
    english = StopWordsRemover.loadDefaultStopWords("english")
    return sorted({*english, *CUSTOM_STOPS, *DOMAIN_STOPS})
