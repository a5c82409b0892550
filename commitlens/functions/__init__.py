"""Column-level helpers (scalar functions F1-F20, derived keys, label rules). All built-in expressions: no UDFs."""

from commitlens.functions.fields import *  # noqa: F401,F403
from commitlens.functions.labels import *  # noqa: F401,F403
