"""Landing formats: what comes in, how it is typed, and what is refused."""
