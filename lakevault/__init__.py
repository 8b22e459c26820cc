"""lakevault: Data Vault and Type-1 dimension loading as Spark DataFrame operators."""

from lakevault.functions import *  # noqa: F401,F403
from lakevault.operators import *  # noqa: F401,F403
from lakevault.sources import *  # noqa: F401,F403

__version__ = "0.1.0"
