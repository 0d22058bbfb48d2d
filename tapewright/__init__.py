"""Quote and trade analytics as Spark DataFrame functions."""

from tapewright.operators import *  # noqa: F403
from tapewright.plans import *  # noqa: F403
from tapewright.sources import *  # noqa: F403
