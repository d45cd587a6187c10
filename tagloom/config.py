"""Labels, column names and default parameters."""

from __future__ import annotations

# Label names, label order for ties, and text limits that results depend on.
UNLABELED = "none"
DROPPED_LABEL = "other-not-news"
LABEL_TAG_PREFIX = "user_need: "

# Corpus stop words and the column names of the stored tables.
CUSTOM_STOP_WORDS = [
    "maine", "said", "one", "also", "people", "state", "year",
    "portland", "time", "like", "would", "get", "new",
]

# The English stop words as Spark ships them, in its order.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

EDA_COLUMNS = [
    "Apikey", "URL", "Title", "text", "Publish_date", "Authors", "Section", "User_Needs",
    "Views", "Avg. views", "Engaged minutes", "Avg. minutes",
    "Desktop views", "Mobile views", "Tablet views",
]
ML_COLUMNS = ["URL", "Title", "text", "User_Needs"]
DERIVED_TEXT_COLUMNS = ["combined_text", "combined_short", "clean_combined", "raw_combined"]

# Limits, sizes and hyperparameters that results depend on.
MAX_CHARS = 2000
TITLE_WEIGHT = 3
RAW_BODY_WORDS = 512
SECTION_TITLE_MAX_CHARS = 1500
MIN_WORD_PIECES = 50

SEED = 42
TOP_K = 3
TEST_SIZE = 0.2
FOLDS = 5
SHOTS_PER_CLASS = 64

VOCAB_SIZE = 10_000
VOCAB_MIN_DF = 3
VOCAB_MAX_DF = 0.95
CLASSIFIER_VOCAB_SIZE = 15_000
CLASSIFIER_MIN_DF = 2
CLASS_VOCAB_SIZE = 5_000

DUPLICATE_THRESHOLD = 0.95
PSEUDO_LABEL_THRESHOLD = 0.85
PSEUDO_LABEL_TOP_N = 50

N_TOPICS = 8
NMF_MAX_ITER = 400
KMEANS_RESTARTS = 10
KMEANS_RANGE = range(3, 16)
MIN_CLUSTER_SIZE = 50
MIN_SAMPLES = 10
CLUSTER_DIMS = 5
DISPLAY_DIMS = 2

LR_MAX_ITER = 2000
LR_TOLERANCE = 1e-4
SVC_MAX_ITER = 5000
SVC_TOLERANCE = 1e-5  # of the gradient, relative to the first
PENALTY_C = 1.0
GBM_TREES = 200
GBM_DEPTH = 5
GBM_RATE = 0.1
RF_TREES = 300
RF_MAX_DEPTH = 30  # Spark's ceiling; stands for "unlimited"
FFNN_HIDDEN = (512, 256, 128)
FFNN_EPOCHS = 30
FFNN_DROPOUT = 0.35
FFNN_RATE = 1e-3
FFNN_WEIGHT_DECAY = 1e-5
FFNN_BATCH_SIZE = 64


PROMPT_TASKS = ("classification", "clustering")

# Columns of a run log that describe the run and are not metric series.
RUN_LOG_SKIP = [
    "run_name", "base_model", "model_id", "saved_at", "elapsed_seconds", "train_size",
    "batch_size", "num_epochs", "num_iterations",
]
