"""Report and schedule plans composed from the operators."""
