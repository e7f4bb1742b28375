from .columns import add, date_text, multiply, subtract, text_date, text_or_empty

__all__ = ["add", "date_text", "multiply", "subtract", "text_date", "text_or_empty"]
