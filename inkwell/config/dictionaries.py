"""Dictionaries and constants as data.

Everything under a "FIXED VALUES" banner must equal the behaviour we
reproduce (keyword lists, entity URIs, party slugs, score maps, filter
lists); it is stated plainly, in natural order.  Operators take these as
default parameters; callers may pass their own tables instead.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: boolean keyword categories (name -> should / should_not)
# ---------------------------------------------------------------------------
CATEGORY_KEYWORDS = {
    "isBLM": {"should": ["Black Lives Matter", "BLM"], "should_not": []},
    "isBrexit": {"should": ["Brexit", "Operation Yellowhammer"], "should_not": []},
    "isCovid": {"should": ["Covid", "Coronavirus", "Self-isolation", "Lockdown",
                           "Contact tracing", "Mers virus",
                           "Joint Biosecurity Centre (JBC)"],
                "should_not": []},
    "isEducation": {"should": ["Education"], "should_not": []},
    "isImmigration": {"should": ["Immigration"], "should_not": []},
    "isEconomy": {"should": ["Economy"], "should_not": []},
}
BOOLEAN_FEATURES = ["isBLM", "isBrexit", "isCovid", "isEducation",
                    "isImmigration", "isEconomy"]

# ---------------------------------------------------------------------------
# FIXED VALUES: entity categories (27 football teams -> topic URI), in order
# ---------------------------------------------------------------------------
FOOTBALL_TEAMS = [
    ("isArsenal", "http://www.bbc.co.uk/things/c4285a9a-9865-2343-af3a-8653f7b70734#id"),
    ("isBournemouth", "http://www.bbc.co.uk/things/0280e88c-26bd-b24c-882f-ae0e5f4142f2#id"),
    ("isBHA", "http://www.bbc.co.uk/things/3d814d88-1f22-d042-a9a6-87fd9216a50a#id"),
    ("isChelsea", "http://www.bbc.co.uk/things/2acacd19-6609-1840-9c2b-b0820c50d281#id"),
    ("isEverton", "http://www.bbc.co.uk/things/48287aac-b015-1d4e-9c4e-9b8abac03789#id"),
    ("isManUtd", "http://www.bbc.co.uk/things/90d9a818-850b-b64f-9474-79e15a0355b8#id"),
    ("isTottenham", "http://www.bbc.co.uk/things/edc20628-9520-044d-92c3-fdec473457be#id"),
    ("isCardiff", "http://www.bbc.co.uk/things/bef8a4b5-1ad1-4347-b665-edf581ab7350#id"),
    ("isFulham", "http://www.bbc.co.uk/things/98c3db4b-498d-7c4b-acb5-d16ffb214f0d#id"),
    ("isHuddersfield", "http://www.bbc.co.uk/things/843257c2-309c-a749-9888-615bb448f887#id"),
    ("isStoke", "http://www.bbc.co.uk/things/ff3ad258-564a-3d46-967a-cefa4e65cfea#id"),
    ("isSwansea", "http://www.bbc.co.uk/things/98105d9f-b1db-0547-b8c7-581abf30c7e9#id"),
    ("isWBA", "http://www.bbc.co.uk/things/7f6edf4a-76f6-4b49-b16b-ff1e232eeb18#id"),
    ("isHull", "http://www.bbc.co.uk/things/10786d02-d602-084f-bfb5-3198a9bebfe7#id"),
    ("isMiddlesbrough", "http://www.bbc.co.uk/things/39a9af5a-c881-a74d-bae7-226ac220df03#id"),
    ("isSunderland", "http://www.bbc.co.uk/things/d5a95ba9-efe6-aa4e-afc4-9adc5f786e58#id"),
    ("isAstonVilla", "http://www.bbc.co.uk/things/9ce8f75f-4dc0-0f46-8e1b-742513527baf#id"),
    ("isNewcastle", "http://www.bbc.co.uk/things/34032412-5e2a-324d-bb3e-d0d4b16df2d4#id"),
    ("isNorwich", "http://www.bbc.co.uk/things/a700cc4d-72eb-a84d-8d7a-73ce435f6985#id"),
    ("isBurnley", "http://www.bbc.co.uk/things/279a3dc2-9195-264d-be3e-2a52bb61d4fe#id"),
    ("isQPR", "http://www.bbc.co.uk/things/81f6a64f-def0-0d40-bc3a-36dab5472f64#id"),
    ("isWolverhampton", "http://www.bbc.co.uk/things/b68a1520-32bc-eb42-8dc0-ccc1018e8e8f#id"),
    ("isLeicester", "http://www.bbc.co.uk/things/ff55aea0-83d7-834c-afc0-d21045f561e9#id"),
    ("isWatford", "http://www.bbc.co.uk/things/7d1d29cb-dab4-a24f-8600-393be1f354fe#id"),
    ("isSouthampton", "http://www.bbc.co.uk/things/6780f83f-a17a-e641-8ec8-226c285a5dbb#id"),
    ("isSheffield", "http://www.bbc.co.uk/things/75f90667-0306-e847-966e-085a11a8f195#id"),
    ("isManCity", "http://www.bbc.co.uk/things/4bdbf21d-d1ad-7147-ab08-612cd0dc20b4#id"),
]
THINGS_URI_PREFIX = "http://www.bbc.co.uk/things/"

# ---------------------------------------------------------------------------
# FIXED VALUES: knowledge-base types, party slugs, political position scores
# ---------------------------------------------------------------------------
PERSON_TYPE = "http://dbpedia.org/ontology/Person"
POLITICAL_PARTY_TYPE = "http://dbpedia.org/ontology/PoliticalParty"
POLITICIAN_TYPE = "http://dbpedia.org/ontology/OfficeHolder"

POLITICAL_PARTIES = ["labour_party", "conservative_party", "liberal_democrats",
                     "scottish_national_party", "democratic_unionist_party",
                     "sinn_féin", "plaid_cymru", "green_party",
                     "social_democratic_unionists",
                     "alliance_party_of_northern_ireland", "brexit_party",
                     "uk_independence_party"]
# output column per slug, in the order above
PARTY_COLUMNS = ["party_labour_refs", "party_conservative_refs",
                 "party_libdems_refs", "party_snp_refs", "party_dup_refs",
                 "party_sinnfein_refs", "party_plaidcymru_refs",
                 "party_greens_refs", "party_sdu_refs", "party_alliance_refs",
                 "party_brexit_refs", "party_ukip_refs"]

# first contained phrase wins, in this order
POLITICAL_POSITION_SCORES = [("left wing", -2), ("centre left", -1),
                             ("centrism", 0), ("center right", 1),
                             ("right wing", 2)]

# ---------------------------------------------------------------------------
# FIXED VALUES: news filter lists
# ---------------------------------------------------------------------------
PRESS_REVIEW_INDICATORS = ["paper review", "newspaper review", "paper headline",
                           "weekly newspaper review", "weekly paper review",
                           "weekly papers", "scotland's paper"]
NATIONS = ["england", "scotland", "wales", "northern-ireland"]
LEGAL_INDICATORS = ["Abuse", "Abused", "Accused", "Accuse", "Accuses",
                    "Allegation", "Alleged", "Allege", "Assault", "Assaulted",
                    "Claim", "Claimed", "Criminal", "Defraud", "Defrauded",
                    "Fraud", "Sexual Harassment", "Illegal", "Investigate",
                    "Investigation", "Scam", "Scammed", "Unlawful", "Victim",
                    "Whistleblower"]
LEGAL_TAGS = ["Alex_Salmond_case", "David_Duckenfield_retrial",
              "Defamation_cases", "Midrar_Ali_case", "El_Chapo_trial",
              "Nazanin_Zaghari-Ratcliffe_case", "William_Taylor_murder_trial",
              "Shamima_Begum_case", "Jodie_Chesney_murder_trial",
              "Grace_Millane_case"]
ARTICLE_TYPE_REGEX = r"([A-Za-z0-9\-]{1,})[0-9]{8}"
SITE_REGEX = r"^/(.+?)/"
RED_BUTTON_MARKER = "DIGIONLY"
COMPETITION_TYPE = "sport:Competition"

# Sport lists are not shipped with the behaviour we reproduce; they are
# parameters with empty defaults.
PERIODICAL_INDICATORS: list[str] = []
RANKINGS_INDICATORS: list[str] = []
SQUAD_INDICATORS: list[str] = []
COMPETITION_DRAW_IDS: list[str] = []

# ---------------------------------------------------------------------------
# FIXED VALUES: entailment topics (name -> terms), hypothesis template
# ---------------------------------------------------------------------------
ENTAILMENT_TOPICS = {
    "isRacial": ["race", "racism", "blm", "black lives matter"],
    "isProtest": ["protest", "boycott", "demonstration", "strike", "riot"],
    "isLawAndOrder": ["police", "crime", "prison", "court", "law enforcement",
                      "officer", "trial", "charged"],
}
ENTAILMENT_FEATURES = ["isRacial", "isProtest", "isLawAndOrder"]
ENTAILMENT_MAX_CHARS = 1024
ENTAILMENT_THRESHOLD = 0.5
THRESHOLD_SWEEP = [0.3, 0.6, 0.9]

# ---------------------------------------------------------------------------
# FIXED VALUES: sentiment label boundaries (label spelling kept)
# ---------------------------------------------------------------------------
SENTIMENT_LABELS = ("mildy_positive", "positive", "mildy_negative",
                    "negative", "neutral")
