from . import expr  # noqa: F401
from .expr import *  # noqa: F401,F403
