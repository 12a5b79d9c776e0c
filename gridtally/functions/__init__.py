from gridtally.functions import times, values

__all__ = ["times", "values"]
