"""DataFrame-to-DataFrame operators."""

from .aggregate import *  # noqa: F401,F403
from .changes import *  # noqa: F401,F403
from .clean import *  # noqa: F401,F403
from .dimensions import *  # noqa: F401,F403
from .facts import *  # noqa: F401,F403
from .identity import *  # noqa: F401,F403
from .joins import *  # noqa: F401,F403
from .people import *  # noqa: F401,F403
from .quality import *  # noqa: F401,F403
