"""These must equal the source systems' spelling for right results."""

# Post types.
ANSWER = "Answer"
QUESTION = "Question"

# Order status that counts as successfully completed.
CLOSED = "Closed"
CLOSED_STATUS_ID = 4

# Delivery log states and statuses. The log spells the receipt state "recieved";
# the written requirement spells it "received", so both are recognised.
BOOKED = "booked"
RECEIVED_STATES = ("recieved", "received")
RETURNED = "returned"
FINISHED = "finished"
IN_PROGRESS = "in_progress"

# Delimited descriptions in the delivery log: one or more colons between fields.
FIELD_SEPARATOR = ":+"

# Payment statuses of the sales feed.
SHIPPED = "shipped"
REFUNDED = "refunded"

# Columns a landing file may carry that never reach staging. A header cell left
# empty by the exporting tool is read as "_c0".
LANDING_EXTRAS = ("id", "Unnamed: 0", "_c0")
