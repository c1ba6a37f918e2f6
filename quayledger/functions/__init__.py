"""Column-level building blocks: time bands, rates, text and number clean-up."""
