"""Column expressions: text, domains, money and clock rules."""
