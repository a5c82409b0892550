"""Stream questions (T0-T8, J3): the same DataFrame functions serve the batch twin and the Structured Stream."""
