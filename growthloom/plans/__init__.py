"""growthloom.plans."""
