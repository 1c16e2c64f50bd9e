"""Column expressions; all of them stay inside whole-stage code generation."""

from .dates import *  # noqa: F401,F403
from .formatting import *  # noqa: F401,F403
from .hashing import *  # noqa: F401,F403
from .masking import *  # noqa: F401,F403
from .money import *  # noqa: F401,F403
from .text import *  # noqa: F401,F403
