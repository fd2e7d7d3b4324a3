"""Fixed values that must equal the studied service for equal results.

Everything here is stated plainly, in natural order, and is not derived.
"""

# --- fixed values: verdict statuses -------------------------------------
STATUS_PENDING = "pending"
STATUS_APPROVED = "approved"
STATUS_REJECTED = "rejected"
STATUS_MANUAL = "manual_review"

# --- fixed values: verdict reasons, in rule order -----------------------
REASON_EMPTY = "empty post"
REASON_TOO_LONG = "content exceeds length limit"
REASON_TOO_MANY_IMAGES = "too many images"
REASON_SENSITIVE = "sensitive word detected"
REASON_LOW_REPUTATION = "low author reputation"
REASON_PASSED = "passed all rules"

# --- fixed values: rule thresholds (defaults; every operator takes them as parameters)
MAX_CONTENT_CHARS = 5000
MAX_IMAGES = 9
REPUTATION_FLOOR = 30

# --- fixed values: reputation model -------------------------------------
REPUTATION_START = 80          # default reputation, also the fail-open value
REPUTATION_PENALTY = 10        # points lost per violation
REPUTATION_MIN = 0

# --- fixed values: approved feed -----------------------------------------
FEED_DEFAULT_LIMIT = 20
FEED_MAX_LIMIT = 100

# --- fixed values: dead letters ------------------------------------------
DLQ_UNMARSHAL = "unmarshal_error"
DLQ_PROCESSING = "processing_error"

# --- fixed values: status cache time-to-live -----------------------------
STATUS_CACHE_TTL_MS = 10 * 60 * 1000

# --- fixed values: token bucket defaults (200 tokens/s, burst 400, cost 1)
RATE_LIMIT_KEY = "post:create"
RATE_PER_SECOND = 200
RATE_BURST = 400

# --- fixed values: dependency-outage trip rule ---------------------------
OUTAGE_MIN_REQUESTS = 5
OUTAGE_FAILURE_RATIO = 0.6

# --- fixed values: demo seeds --------------------------------------------
SEED_WORDS = ["spam", "scam", "casino", "viagra", "违禁品", "暴力"]
SEED_USERS = [
    # (user_id, username, email, reputation, violation_count)
    (1, "alice", "alice@example.com", 80, 0),
    (2, "bob", "bob@example.com", 80, 0),
    (3, "troll", "troll@example.com", 20, 6),
]
LOADGEN_SENTENCE = "an ordinary generated text, number "
LOADGEN_BAD_SUFFIX = " with casino chips"
LOADGEN_TITLE = "generated"

# --- fixed values: test-data block list (raw, before folding) ------------
TESTDATA_WORDS = ["trash", "Idiot", "idiot", "clown", "scum", "worthless", "less",
                  "moron", "pathetic", "loser", "disgusting", "stupid", ""]

UPPER_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_ASCII = "abcdefghijklmnopqrstuvwxyz"
