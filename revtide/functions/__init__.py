from revtide.functions.dates import *  # noqa: F401,F403
from revtide.functions.labels import *  # noqa: F401,F403
from revtide.functions.revenue import *  # noqa: F401,F403
