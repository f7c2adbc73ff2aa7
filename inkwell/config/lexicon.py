"""Valence lexicon and rule constants for the lexicon sentiment scorer.

The rule constants and modifier word lists follow the published VADER
method (Hutto & Gilbert, 2014).  The word table below is a small lexicon on the
same -4..4 scale; where a valence equals that of the public VADER lexicon, it
is that lexicon's value.  Pass a full ``(term, valence)`` table to the scorer
to replace it."""

# ---------------------------------------------------------------------------
# FIXED VALUES: rule constants
# ---------------------------------------------------------------------------
B_INCR = 0.293
B_DECR = -0.293
C_INCR = 0.733
N_SCALAR = -0.74
NORM_ALPHA = 15.0
EXCLAIM_WEIGHT = 0.292
QUESTION_WEIGHT = 0.18
QUESTION_CAP = 0.96
DAMPING = {1: 1.0, 2: 0.95, 3: 0.9}

# ---------------------------------------------------------------------------
# FIXED VALUES: modifier words
# ---------------------------------------------------------------------------
NEGATIONS = ["aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt",
             "ain't", "aren't", "can't", "couldn't", "daren't", "didn't", "doesn't",
             "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither",
             "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't",
             "neednt", "needn't", "never", "none", "nope", "nor", "not", "nothing", "nowhere",
             "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent",
             "oughtn't", "shan't", "shouldn't", "uh-uh", "wasn't", "weren't",
             "without", "wont", "wouldnt", "won't", "wouldn't", "rarely", "seldom", "despite"]

BOOSTERS_UP = ["absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly",
               "deeply", "effing", "enormously", "entirely", "especially", "exceptionally",
               "extremely", "fabulously", "flipping", "flippin", "fricking", "frickin",
               "frigging", "friggin", "fully", "greatly", "hella", "highly", "hugely",
               "incredibly", "intensely", "majorly", "more", "most", "particularly", "purely",
               "quite", "really", "remarkably", "so", "substantially", "thoroughly", "totally",
               "tremendously", "uber", "unbelievably", "unusually", "utterly", "very"]
BOOSTERS_DOWN = ["almost", "barely", "hardly", "kinda", "kindof", "kind-of", "less", "little",
                 "marginally", "occasionally", "partly", "scarcely", "slightly", "somewhat",
                 "sorta", "sortof", "sort-of"]

# ---------------------------------------------------------------------------
# Default lexicon (term -> valence)
# ---------------------------------------------------------------------------
DEFAULT_LEXICON = {
    "abandon": -1.9, "abuse": -3.2, "accept": 1.6, "admire": 2.1, "afraid": -2.0,
    "agree": 1.5, "alarm": -1.4, "amazing": 2.8, "anger": -2.7, "angry": -2.3,
    "annoy": -1.9, "anxious": -1.0, "approve": 1.7, "attack": -2.1, "awful": -2.0,
    "awesome": 3.1, "bad": -2.5, "beautiful": 2.9, "best": 3.2, "better": 1.9,
    "blame": -1.4, "bless": 1.8, "bored": -1.1, "brave": 2.4, "bright": 1.9,
    "broken": -2.1, "calm": 1.3, "care": 2.2, "celebrate": 2.7, "charm": 1.7,
    "cheat": -2.1, "cheer": 2.3, "clean": 1.7, "clever": 2.0, "comfort": 1.5,
    "confident": 2.2, "confused": -1.3, "cool": 1.3, "crash": -1.7, "crazy": -1.4,
    "crime": -2.5, "crisis": -3.1, "cruel": -2.8, "cry": -2.1, "damage": -2.2,
    "danger": -2.4, "dead": -3.3, "death": -2.9, "defeat": -2.0, "delight": 2.9,
    "despair": -3.0, "destroy": -2.7, "disappoint": -2.3, "disaster": -3.1,
    "dislike": -1.6, "dumb": -2.3, "easy": 1.9, "enjoy": 2.2, "evil": -3.4,
    "excellent": 2.7, "excited": 1.4, "fail": -2.5, "failure": -2.3, "fair": 1.3,
    "fake": -2.1, "fantastic": 2.6, "fear": -2.2, "fine": 0.8, "fool": -1.9,
    "fraud": -2.8, "free": 2.3, "friend": 2.2, "fun": 2.3, "funny": 1.9,
    "glad": 2.0, "good": 1.9, "great": 3.1, "grief": -2.2, "guilty": -1.8,
    "handsome": 2.2, "happy": 2.7, "harm": -2.5, "hate": -2.7, "healthy": 1.7,
    "help": 1.7, "honest": 2.3, "hope": 1.9, "horrible": -2.5, "hurt": -2.4,
    "idiot": -2.3, "ill": -1.9, "important": 0.8, "impressive": 2.3, "injury": -2.4,
    "joy": 2.8, "kill": -3.7, "kind": 2.4, "lie": -1.6, "like": 1.5, "lose": -1.3,
    "loss": -1.3, "love": 3.2, "lucky": 1.9, "mad": -2.2, "mess": -1.5, "miss": -0.6,
    "nasty": -2.6, "nice": 1.8, "ok": 1.2, "okay": 0.9, "pain": -2.3, "panic": -2.3,
    "peace": 2.5, "perfect": 2.7, "pleasant": 2.3, "poor": -2.1, "pretty": 2.2,
    "problem": -1.7, "proud": 2.1, "rich": 2.6, "risk": -1.1, "sad": -2.1,
    "safe": 1.9, "scam": -2.7, "scandal": -1.9, "scared": -1.9, "shame": -2.1,
    "sick": -2.3, "smart": 1.7, "sorry": -0.3, "strong": 2.3, "stupid": -2.4,
    "succeed": 2.2, "success": 2.7, "suffer": -2.5, "super": 2.9, "sweet": 2.0,
    "terrible": -2.1, "thank": 1.5, "threat": -2.4, "trash": -1.5, "trouble": -1.7,
    "true": 1.8, "trust": 2.3, "ugly": -2.3, "unfair": -2.1, "unhappy": -1.8,
    "upset": -1.6, "useless": -1.8, "victim": -2.7, "violent": -2.9, "war": -2.9,
    "weak": -1.9, "welcome": 2.0, "win": 2.8, "winner": 2.8, "wonderful": 2.7,
    "worry": -1.9, "worse": -2.1, "worst": -3.1, "worthless": -1.9, "wrong": -2.1,
}

# ---------------------------------------------------------------------------
# FIXED VALUES: emoticons and idioms (term -> valence), after the published
# VADER method
# ---------------------------------------------------------------------------
EMOTICONS = {
    ":)": 2.0, ":-)": 1.3, ":d": 2.3, ":-d": 2.3, ";)": 0.9, ";-)": 1.0, "<3": 1.9, ":p": 1.0,
    "=)": 2.2, ":*": 1.9, ":(": -1.9, ":-(": -1.5, ":'(": -2.2, ":/": -1.4, ":-/": -1.2,
    ">:(": -2.7, "</3": -3.0, ":|": -0.4,
}

IDIOMS = {
    "cut the mustard": 2.0, "hand to mouth": -2.0, "back handed": -2.0, "blow smoke": -2.0,
    "blowing smoke": -2.0, "upper hand": 1.0, "break a leg": 2.0, "cooking with gas": 2.0,
    "in the black": 2.0, "in the red": -2.0, "on the ball": 2.0, "under the weather": -2.0,
    "the bomb": 3.0, "bad ass": 1.5, "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5,
    "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
}
