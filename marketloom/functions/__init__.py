from marketloom.functions.csvtext import (  # noqa: F401
    csv_line,
    csv_line_of,
    csv_record,
    strip_whitespace,
    utf8_text,
)
from marketloom.functions.numbers import (  # noqa: F401
    installs_number,
    plain_number,
    price_number,
    size_megabytes,
)
