from wordmill.functions import patterns, text  # noqa: F401
