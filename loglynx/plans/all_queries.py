"""Import every query module so the registry is complete."""

from . import rule_queries  # noqa: F401
from . import alert_queries  # noqa: F401
from . import parse_queries  # noqa: F401
from . import serve_queries  # noqa: F401
from . import stored_queries  # noqa: F401
from . import stream_queries  # noqa: F401
from . import robust_queries  # noqa: F401
from . import file_queries  # noqa: F401
