"""Reading landed data and writing tables."""

from .api_pages import *  # noqa: F401,F403
from .databases import *  # noqa: F401,F403
from .landing import *  # noqa: F401,F403
from .logs import *  # noqa: F401,F403
from .sheets import *  # noqa: F401,F403
from .tables import *  # noqa: F401,F403
