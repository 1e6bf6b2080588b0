"""Names and addresses, clocks, dates and provider responses as column expressions."""
