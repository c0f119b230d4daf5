"""Column expressions: text, HTML, URLs, dates, language and scoring."""
