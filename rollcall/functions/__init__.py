from rollcall.functions import dates, labels, numbers, text  # noqa: F401
