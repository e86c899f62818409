"""growthloom.operators."""
