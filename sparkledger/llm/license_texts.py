"""Short notices of public licences: the templates of the licence scan.  Fixed values."""

TEMPLATES: dict[str, str] = {
    "mit-notice": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "apache-2-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-nc-4-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mpl-2-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
