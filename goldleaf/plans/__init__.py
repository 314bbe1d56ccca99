"""The datasets a user asks for, layer by layer. Each is a function from DataFrames to a DataFrame."""
