"""Fixed values that must equal the original program's for equal results.

Everything here is plain data, kept together and in its natural order.
Larger lexical resources (dictionary, word vectors, lemma vocabulary,
sentiment lexicon) are DataFrame parameters, not shipped tables.
"""

# --- fixed values: English stop-word list (the classic 179-word NLTK list) ---
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below",
    "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t",
    "can", "will", "just", "don", "don't", "should", "should've", "now", "d", "ll",
    "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't",
    "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn",
    "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't",
    "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
)

# --- fixed values: key phrases counted per post (substring containment) ---
KEY_PHRASES = (
    "full time", "goal", "half time", "kick off", "owngoal", "penalty", "match",
    "red card", "yellow card",
)

# --- fixed values: noun suffix rules of the WordNet morphological analyser ---
# (suffix, replacement), in the analyser's order.
NOUN_SUFFIX_RULES = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)

# --- fixed values: a few irregular noun plurals used when no exception table
# is given (a full exception table is a parameter) ---
NOUN_EXCEPTIONS = (
    ("children", "child"), ("feet", "foot"), ("geese", "goose"), ("mice", "mouse"),
    ("teeth", "tooth"), ("lice", "louse"), ("oxen", "ox"),
)

# --- fixed values: spelling correction (max edit distance, prefix length) ---
SPELL_MAX_DISTANCE = 2
SPELL_PREFIX_LENGTH = 7

# --- fixed values: sentiment normalisation s / sqrt(s*s + alpha), 4 decimals ---
SENTIMENT_ALPHA = 15.0
SENTIMENT_DECIMALS = 4

# --- fixed values: hold-out draw of the original program ---
# 16 training group ids in file order, their period counts, and the ids that
# a seeded (42) draw of int(0.3 * 16) = 4 groups selects.
REFERENCE_GROUP_IDS = (11, 12, 10, 14, 8, 2, 5, 13, 4, 17, 0, 19, 7, 3, 18, 1)
REFERENCE_GROUP_PERIODS = (130, 97, 175, 130, 130, 130, 130, 130, 170, 130, 130, 130,
                           130, 130, 130, 110)
REFERENCE_TEST_GROUP_IDS = (14, 11, 19, 8)

# --- fixed values: model settings of the original program ---
SEED = 42
