"""Values the scoring jobs share with the systems around them.

Fixed values: column names and order, message texts, batch intervals and the
checked field must stay exactly as they are, because feeds, tables and topic
readers depend on them.
"""

# Field layouts, in feed order.
MRI11_FIELDS = (
    "AGE", "TURN", "bhour", "ITEM_n", "ORDERDR_n", "MODEL_NAME_n",
    "IO_n", "DEPT_n", "SEX_n", "POS_n", "MD_NO_n",
)
KEYED7_FIELDS = ("Item", "ORDERDR", "DEPT", "SEX", "AGE", "POS", "IO")
PEOPLE9_FIELDS = ("PNO", "Item", "ORDERDR", "DEPT", "SEX", "AGE", "POS", "IO", "SECOND")
KAFKA8_SIZE = 8

# The field whose integer check decides whether a line is kept.
CHECKED_FIELD = 10

# Columns of the result table.
RESULT_COLUMNS = ("PNO", "PRETIME", "Time")
RESULT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Message texts. `{}` takes a value.
MINUTES_MESSAGE = "The Patient NO. is {}, need {} minutes to detect by MRI"
SECONDS_MESSAGE = "The AI predict that {} seconds to detect from  MRI"
SECONDS_LINE = "This patient need {} seconds to detect from MRI"
KEY_MINUTES_LINE = "{},{}"
MISSING_KEY = "None"

# Micro-batch intervals.
KAFKA_INTERVAL = "3 seconds"
SOCKET_INTERVAL = "5 seconds"
IMAGE_INTERVAL = "10 seconds"

# Rows of each batch that the console sink shows.
CONSOLE_ROWS = 10

# The table of people and the question asked of it.
PEOPLE_VIEW = "people"
PEOPLE_QUERY = "select PNO, SECOND from people where AGE > 20 and IO = 2"
