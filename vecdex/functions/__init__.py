from vecdex.functions import text, vectors  # noqa: F401
