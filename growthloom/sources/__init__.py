"""growthloom.sources."""
