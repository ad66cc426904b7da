"""Formats and defaults that results depend on."""

# Names of catalogs, namespaces, tables and keys must match this in full.
IDENTIFIER = r"[a-zA-Z_][a-zA-Z0-9_]*"

# Card accounts: one row per card, money as double, dates as yyyy-MM-dd text.
CARD_SCHEMA = """
    card_id STRING, card_number_masked STRING, cardholder_name STRING,
    account_id STRING, credit_limit DOUBLE, current_balance DOUBLE,
    available_credit DOUBLE, card_status STRING, card_type STRING,
    issue_date STRING, expiry_date STRING, billing_cycle_day INT,
    minimum_payment DOUBLE, annual_fee DOUBLE, interest_rate DOUBLE,
    last_transaction_date STRING, last_payment_date STRING,
    last_payment_amount DOUBLE, reward_points BIGINT, is_primary BOOLEAN,
    currency STRING
"""
CARD_KEY = "card_id"
CARD_STATUSES = ("ACTIVE", "INACTIVE", "BLOCKED", "EXPIRED")

# Card transactions.
TRANSACTION_SCHEMA = """
    transaction_id STRING, card_id STRING, account_id STRING,
    transaction_date STRING, posted_date STRING, amount DOUBLE,
    transaction_type STRING, merchant_name STRING, merchant_category STRING,
    merchant_city STRING, merchant_state STRING, merchant_country STRING,
    status STRING, description STRING, currency STRING,
    reward_points_earned INT
"""
TRANSACTION_KEY = "transaction_id"

# Chunking and retrieval defaults.
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
EMBED_DIMS = 1024
TOP_K = 5

# A chunk's key is the sha1 of "<source key>#<index>".
CHUNK_KEY_SEPARATOR = "#"

# Text holding at least one character outside this class is not blank.
NOT_BLANK = r"(?U)[^\s\x1c-\x1f]"

# Prompt layout and request body.
CONTEXT_SEPARATOR = "\n\n---\n\n"
UNKNOWN_SOURCE = "unknown"
UNKNOWN_INDEX = "?"
PROMPT_VERSION = "bedrock-2023-05-31"
PROMPT_MAX_TOKENS = 2048
PROMPT_SYSTEM = (
    "You are a helpful assistant for a banking data platform. "
    "Answer the user's question using only the provided context. "
    "If the context does not contain enough information, say so clearly. "
    "Do not fabricate facts."
)

# Offer score: points for APR, fee, rewards and sign-up bonus.
APR_POINTS, APR_FREE = 30.0, 10.0
FEE_POINTS, FEE_PER_POINT = 25.0, 20.0
REWARDS_POINTS = 25.0
BONUS_POINTS = 20.0

# Ranked document and the call that carries its payload.
RANKING_SOURCE = "web_search"
SAVE_CALL = "save_top_cards"
SAVE_FIELD = "cards_json"

# Notifications: object prefix and batch bounds.
DATA_PREFIX = "data/"
MAX_MESSAGES = 10
BATCH_WAIT = "30 seconds"
