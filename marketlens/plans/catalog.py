"""Importing this module registers every query of the engine."""

from . import registry  # noqa: F401
from . import q_time  # noqa: F401
from . import q_analysis  # noqa: F401
from . import q_io  # noqa: F401
from . import q_feeds  # noqa: F401
from . import q_stream  # noqa: F401
from . import q_series  # noqa: F401
