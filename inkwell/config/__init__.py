from inkwell.config.dictionaries import *  # noqa: F401,F403
