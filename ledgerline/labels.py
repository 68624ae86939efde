"""Label vocabulary of the ledger.

Labels are configuration data, not code.  These are invented English
equivalents of the categories the modelled jobs use; every rule and fixture
refers to them through these names.
"""

# fixed values: segments
TRUCK = "truck"
BUS = "bus"

# fixed values: scenes
SIGNING = "signing"
FIRST_USE = "first_use"
NEW_PAID = "new_paid"
AFTER_SALES = "after_sales"
CANCELLATION = "cancellation"
WAIVER = "waiver"
CARD_SWAP = "card_swap"
PREPAID = "prepaid"
BUY_OUT = "buy_out"
CANCEL_PAID = "cancel_paid"
AFTER_SALES_PAID = "after_sales_paid"

# fixed values: data types and adjustment types
RECEIVABLE = "receivable"
RECEIVED = "received"
ADJUSTMENT = "adjustment"
INCREASE = "increase"
DECREASE = "decrease"
NORMAL = "normal"
RECEIVABLE_DECREASE = "receivable_decrease"
RECEIVED_DECREASE = "received_decrease"

# fixed values: service types and scenes of the service detail table
COLLECT = "collect"
REFUND = "refund"
SERVICE_REPLACE = "replace"
SERVICE_CANCEL = "cancel"
SERVICE_NEW = "new"
SERVICE_REBIND_REFUND = "rebind_refund"

# fixed values: departments
DEPT_ETC = "etc"
DEPT_DATA = "data"
DEPT_LIVE = "live_stream"
DEPT_SMART = "smart_device"

# fixed values: membership flag
YES = "yes"
NO = "no"

# fixed values: province fallback
OTHER = "other"
