"""Fixed values.

Values that must equal the reference's for the results to agree, stated
plainly and together.  Everything else in the package derives from these.
"""

# ---- fixed values (must equal the reference's) ----

# order status ids of the status dictionary: 1 Open, 2 Cooking, 3 Delivering, 4 Closed, 5 Cancelled
STATUS_CLOSED = 4
STATUS_CANCELLED = 5
FINAL_STATUSES = (4, 5)

# RFM: number of NTILE buckets
RFM_BUCKETS = 5

# sales feed: status values, default for a missing status, retention period name
STATUS_SHIPPED = "shipped"
STATUS_REFUNDED = "refunded"
PERIOD_WEEKLY = "weekly"

# shipping log: status of a finished shipment, descriptor separator (regex)
SHIPPING_FINISHED = "finished"
DESCRIPTOR_SEPARATOR = ":+"

# bonus system: event type of a payment, bonus grant share of the payment
EVENT_BONUS_TRANSACTION = "bonus_transaction"
BONUS_GRANT_RATE = "0.01"

# documents: timestamp text format, open-ended validity end, documents per copy session
DOC_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
VALIDITY_SENTINEL = "2099-12-31 00:00:00"
SESSION_LIMIT = 10_000
