"""Column functions: text, dates, hrefs and JSON payloads."""
